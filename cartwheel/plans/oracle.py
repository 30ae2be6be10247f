"""Reference SQL (DuckDB dialect) for the registered queries, over the driver's tables.

Each string starts from the same adapter as the Spark side. Rates use exact
integer half-up rounding; sums are cast to BIGINT and row numbers to INT.
"""

from __future__ import annotations

from cartwheel.plans import params as P

_CTE = """
src AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'USER-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS user_id,
         'PROD-' || lpad(CAST(k % 20 + 1 AS VARCHAR), 3, '0') AS product_id,
         CASE WHEN k >= 95 THEN NULL WHEN k % 20 < 5 THEN 'Laptops' WHEN k % 20 < 10 THEN 'Smartphones'
              WHEN k % 20 < 15 THEN 'Accessories' ELSE 'TVs' END AS category,
         CASE event_type WHEN 'click' THEN 'view' WHEN 'signup' THEN 'add_to_cart' ELSE event_type END AS event_type,
         ts AS event_time,
         event_id AS uid, user_id AS unum
  FROM src),
valid AS (SELECT * FROM ev WHERE event_type IN ('view', 'add_to_cart', 'purchase')),
agg AS (
  SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, product_id,
         COUNT(*) FILTER (WHERE event_type = 'view') AS view_count,
         COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_count,
         COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase_count
  FROM (SELECT *, date_trunc('hour', event_time) - to_hours(i) AS window_start
        FROM (SELECT *, unnest(range(0, 6)) AS i FROM ev))
  GROUP BY window_start, product_id),
alerts AS (
  SELECT product_id, view_count, purchase_count, window_start, window_end,
         'High interest detected — consider launching a Flash Sale or targeted discount.' AS alert_message,
         window_end AS created_at
  FROM agg WHERE view_count > 2 AND purchase_count < 1),
pday AS (
  SELECT CAST(event_time AS DATE) AS report_date, product_id,
         COUNT(*) FILTER (WHERE event_type = 'view') AS total_views,
         COUNT(*) FILTER (WHERE event_type = 'purchase') AS total_purchases
  FROM valid WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-02-01'
  GROUP BY 1, 2),
report AS (
  SELECT report_date, CAST(rank AS INTEGER) AS rank, product_id, total_views, total_purchases,
         CASE WHEN total_views = 0 THEN 0.0
              ELSE CAST((20000 * total_purchases + total_views) // (2 * total_views) AS DOUBLE) / 1e4 END
           AS conversion_rate
  FROM (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY total_views DESC, product_id) AS rank
        FROM pday)
  WHERE rank <= 5),
useg AS (
  SELECT CAST(event_time AS DATE) AS segment_date, user_id,
         COUNT(*) FILTER (WHERE event_type = 'view') AS total_views,
         COUNT(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
         COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS total_carts
  FROM valid WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-02-01'
  GROUP BY 1, 2),
seg AS (
  SELECT segment_date, user_id,
         CASE WHEN total_purchases > 0 THEN 'Buyer' ELSE 'Window Shopper' END AS segment,
         total_views, total_purchases FROM useg),
seg3 AS (
  SELECT segment_date, user_id,
         CASE WHEN total_purchases > 0 THEN 'Buyer' WHEN total_carts > 0 THEN 'Prospective Buyer'
              ELSE 'Window Shopper' END AS segment,
         total_views, total_purchases FROM useg),
conv AS (
  SELECT report_date, category, product_id, total_views, total_purchases,
         CAST((20000 * total_purchases + total_views) // (2 * total_views) AS DOUBLE) / 1e4 AS conversion_rate
  FROM (SELECT CAST(event_time AS DATE) AS report_date, COALESCE(category, 'Unknown') AS category, product_id,
               COUNT(*) FILTER (WHERE event_type = 'view') AS total_views,
               COUNT(*) FILTER (WHERE event_type = 'purchase') AS total_purchases
        FROM valid WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-02-01'
        GROUP BY 1, 2, 3)
  WHERE total_views > 0),
cat AS (
  SELECT report_date, category, CAST(SUM(total_views) AS BIGINT) AS total_views,
         CAST(SUM(total_purchases) AS BIGINT) AS total_purchases
  FROM conv GROUP BY 1, 2),
cat2 AS (
  SELECT *, CAST(total_purchases AS DOUBLE) / CAST(total_views AS DOUBLE) * 100 AS conversion_pct,
         printf('%.2f', CAST(total_purchases AS DOUBLE) / CAST(total_views AS DOUBLE) * 100) || '%'
           AS conversion_text
  FROM cat),
days AS (SELECT CAST(d AS DATE) AS report_date
         FROM (SELECT unnest(range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY)) AS d))
"""


def _q(body: str) -> str:
    return "WITH " + _CTE.strip() + "\n" + body.strip()


def _rate(p: str, v: str) -> str:
    return (f"CASE WHEN {v} = 0 THEN 0.0 ELSE CAST((20000 * {p} + {v}) // (2 * {v}) AS DOUBLE) / 1e4 END")


def _pct2(p: str, v: str) -> str:
    return (f"CASE WHEN {v} = 0 THEN 0.0 ELSE CAST((20000 * {p} + {v}) // (2 * {v}) AS DOUBLE) / 1e2 END")


def _pct_text_of_rate(r: str) -> str:
    return f"printf('%.2f', {r} * 100) || '%'"


_OFFSET = """event_time >= TIMESTAMP '2024-01-15 06:00:00' AND event_time < TIMESTAMP '2024-01-16 06:00:00'"""
_BAD_TYPE = "CASE WHEN event_type NOT IN ('view', 'add_to_cart', 'purchase') THEN 'bad_event_type' END"

SQL = {
    "quarantine_reasons": f"""
        SELECT reason, COUNT(*) AS rows FROM (
          SELECT CASE uid % 12
                   WHEN 0 THEN 'missing_event_id,missing_user_id,missing_product_id,missing_event_type,bad_event_time'
                   WHEN 1 THEN concat_ws(',', 'bad_event_time', {_BAD_TYPE})
                   WHEN 2 THEN concat_ws(',', 'missing_user_id', {_BAD_TYPE})
                   WHEN 3 THEN concat_ws(',', {_BAD_TYPE}, 'too_long_product_id')
                   ELSE {_BAD_TYPE} END AS reason
          FROM ev)
        WHERE reason IS NOT NULL GROUP BY reason""",
    "report_offset_interval": f"""
        SELECT DATE '2024-01-15' AS report_date, CAST(rank AS INTEGER) AS rank, product_id, total_views, total_purchases,
               {_rate('total_purchases', 'total_views')} AS conversion_rate
        FROM (SELECT *, row_number() OVER (ORDER BY total_views DESC, product_id) AS rank
              FROM (SELECT product_id, COUNT(*) FILTER (WHERE event_type = 'view') AS total_views,
                           COUNT(*) FILTER (WHERE event_type = 'purchase') AS total_purchases
                    FROM valid WHERE {_OFFSET} GROUP BY product_id))
        WHERE rank <= 5""",
    "segments_offset_interval": f"""
        SELECT DATE '2024-01-15' AS segment_date, user_id,
               CASE WHEN total_purchases > 0 THEN 'Buyer' ELSE 'Window Shopper' END AS segment, total_views, total_purchases
        FROM (SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'view') AS total_views,
                     COUNT(*) FILTER (WHERE event_type = 'purchase') AS total_purchases
              FROM valid WHERE {_OFFSET} GROUP BY user_id)""",
    "default_stamps": """
        SELECT segment_date, COUNT(*) AS rows, CAST(SUM(total_purchases) AS BIGINT) AS total_purchases,
               CAST(0 AS BIGINT) AS null_counts, CAST(0 AS BIGINT) AS odd_stamps
        FROM seg GROUP BY segment_date""",
    "decode_valid": "SELECT event_id, user_id, product_id, category, event_type, event_time FROM valid",
    "quarantine": """SELECT event_id, event_type, event_time, 'bad_event_type' AS reason
                     FROM ev WHERE event_type NOT IN ('view', 'add_to_cart', 'purchase')""",
    "json_roundtrip": "SELECT event_id, user_id, product_id, category, event_type, event_time FROM ev",
    "topic_first_n": """SELECT uid AS "offset", event_id, product_id, event_type FROM ev
                        ORDER BY uid LIMIT 5""",
    "raw_wide": """SELECT event_id, user_id, product_id, category, event_type, event_time,
                          'SESSION-' || user_id || '-' || strftime(event_time, '%Y%m%d') AS session_id,
                          ['desktop', 'mobile', 'tablet'][unum % 3 + 1] AS device,
                          ['organic', 'paid_search', 'email', 'social', 'direct'][uid % 5 + 1] AS referrer,
                          event_time AS kafka_timestamp
                   FROM valid""",
    "quality_duplicates": """
        SELECT 'clickstream_events' AS table_name, 'event_id' AS key_columns, CAST(COUNT(*) AS BIGINT) AS row_count,
               CAST(COUNT(DISTINCT event_id) AS BIGINT) AS distinct_keys,
               CAST((SELECT COUNT(*) FROM (SELECT event_id FROM valid GROUP BY 1 HAVING COUNT(*) > 1)) AS BIGINT)
                 AS duplicate_keys FROM valid
        UNION ALL
        SELECT 'product_view_aggregates', 'window_start,window_end,product_id', COUNT(*),
               (SELECT COUNT(*) FROM (SELECT 1 FROM agg GROUP BY window_start, window_end, product_id)),
               (SELECT COUNT(*) FROM (SELECT 1 FROM agg GROUP BY window_start, window_end, product_id
                                      HAVING COUNT(*) > 1)) FROM agg
        UNION ALL
        SELECT 'flash_sale_alerts', 'product_id,window_start,window_end', COUNT(*),
               (SELECT COUNT(*) FROM (SELECT 1 FROM alerts GROUP BY product_id, window_start, window_end)),
               (SELECT COUNT(*) FROM (SELECT 1 FROM alerts GROUP BY product_id, window_start, window_end
                                      HAVING COUNT(*) > 1)) FROM alerts
        UNION ALL
        SELECT 'user_segments', 'segment_date,user_id', COUNT(*),
               (SELECT COUNT(*) FROM (SELECT 1 FROM seg GROUP BY segment_date, user_id)),
               (SELECT COUNT(*) FROM (SELECT 1 FROM seg GROUP BY segment_date, user_id HAVING COUNT(*) > 1)) FROM seg
        UNION ALL
        SELECT 'daily_product_report', 'report_date,rank', COUNT(*),
               (SELECT COUNT(*) FROM (SELECT 1 FROM report GROUP BY report_date, rank)),
               (SELECT COUNT(*) FROM (SELECT 1 FROM report GROUP BY report_date, rank HAVING COUNT(*) > 1))
        FROM report""",
    "rate_overflow": f"""SELECT report_date, product_id, total_views, total_purchases,
                                {_rate('total_purchases', 'total_views')} AS conversion_rate,
                                ({_rate('total_purchases', 'total_views')}) < 100 AS fits_decimal
                         FROM pday""",
    "segments_domain": """SELECT segment_date, segment, COUNT(*) AS users,
                                 segment IN ('Buyer', 'Window Shopper') AS in_domain
                          FROM seg GROUP BY 1, 2""",
    "sliding_counts": "SELECT * FROM agg",
    "flash_sale": """SELECT product_id, view_count, purchase_count, window_start, window_end, alert_message
                     FROM alerts""",
    "window_event_type_counts": """
        SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, product_id, event_type,
               COUNT(*) AS event_count
        FROM (SELECT *, time_bucket(INTERVAL 2 HOUR, event_time) - to_hours(2 * i) AS window_start
              FROM (SELECT *, unnest(range(0, 3)) AS i FROM ev))
        GROUP BY window_start, product_id, event_type""",
    "window_conversion": f"SELECT *, {_rate('purchase_count', 'view_count')} AS conversion_rate FROM agg",
    "user_segments": "SELECT * FROM seg",
    "segments_three_way": "SELECT * FROM seg3",
    "segment_share": f"""
        SELECT segment_date, segment, users, day_users, {_pct2('users', 'day_users')} AS share_pct
        FROM (SELECT *, CAST(SUM(users) OVER (PARTITION BY segment_date) AS BIGINT) AS day_users
              FROM (SELECT segment_date, segment, COUNT(*) AS users FROM seg3 GROUP BY 1, 2))""",
    "daily_top_products": "SELECT * FROM report",
    "conversion_by_product": "SELECT * FROM conv",
    "category_conversion": "SELECT * FROM cat2",
    "category_map_conversion": f"""
        SELECT p.report_date, p.product_id,
               COALESCE(CASE WHEN CAST(substr(p.product_id, 6) AS INTEGER) <= 5 THEN 'Laptops'
                             WHEN CAST(substr(p.product_id, 6) AS INTEGER) <= 10 THEN 'Smartphones'
                             WHEN CAST(substr(p.product_id, 6) AS INTEGER) <= 15 THEN 'Accessories'
                             WHEN CAST(substr(p.product_id, 6) AS INTEGER) <= 20 THEN 'TVs' END, 'Unknown')
                 AS category,
               p.total_views, p.total_purchases,
               {_pct2('p.total_purchases', 'p.total_views')} AS conversion_rate_pct
        FROM pday p""",
    "top_from_aggregates": f"""
        SELECT product_id, total_views, total_purchases, CAST(rank AS INTEGER) AS rank,
               {_rate('total_purchases', 'total_views')} AS conversion_rate
        FROM (SELECT *, row_number() OVER (ORDER BY total_views DESC, product_id) AS rank
              FROM (SELECT product_id, CAST(SUM(view_count) AS BIGINT) AS total_views,
                           CAST(SUM(purchase_count) AS BIGINT) AS total_purchases FROM agg GROUP BY 1))
        WHERE rank <= 5""",
    "top_products_text": f"""
        SELECT report_date, line_no, line FROM (
          SELECT report_date, 1 AS line_no, 'E-Commerce Daily Top Product Summary' AS line FROM days
          UNION ALL SELECT report_date, 2, 'Report Date: ' || CAST(report_date AS VARCHAR) FROM days
          UNION ALL SELECT report_date, 3, '' FROM days
          UNION ALL SELECT report_date, 4, 'Rank | Product ID | Views | Purchases | Conversion Rate' FROM days
          UNION ALL SELECT report_date, 5, '-----|------------|-------|-----------|----------------' FROM days
          UNION ALL SELECT report_date, 5 + rank,
                           CAST(rank AS VARCHAR) || ' | ' || product_id || ' | ' || CAST(total_views AS VARCHAR)
                           || ' | ' || CAST(total_purchases AS VARCHAR) || ' | ' || {_pct_text_of_rate('conversion_rate')}
                    FROM report
          UNION ALL SELECT report_date, 6, 'No clickstream activity was recorded for this interval.'
                    FROM days WHERE report_date NOT IN (SELECT report_date FROM report))""",
    "conversion_csv": """
        SELECT report_date,
               CAST(row_number() OVER (PARTITION BY report_date
                    ORDER BY category, conversion_rate DESC, total_views DESC, product_id) AS INTEGER) AS line_no,
               category, product_id, total_views, total_purchases,
               printf('%.4f', conversion_rate) AS conversion_rate
        FROM conv""",
    "category_summary_text": """
        SELECT report_date, line_no, line FROM (
          SELECT report_date, 1 AS line_no, 'Conversion Rate Summary by Product Category' AS line FROM days
          UNION ALL SELECT report_date, 2, 'Report Date: ' || CAST(report_date AS VARCHAR) FROM days
          UNION ALL SELECT report_date, 3, '' FROM days
          UNION ALL SELECT report_date, 4, 'Category | Views | Purchases | Conversion Rate' FROM days
          UNION ALL SELECT report_date, 5, '---------|-------|-----------|----------------' FROM days
          UNION ALL SELECT report_date,
                           CAST(5 + row_number() OVER (PARTITION BY report_date ORDER BY category) AS INTEGER),
                           category || ' | ' || CAST(total_views AS VARCHAR) || ' | '
                           || CAST(total_purchases AS VARCHAR) || ' | ' || conversion_text
                    FROM cat2
          UNION ALL SELECT report_date, 6,
                           'No qualifying view activity was recorded for the selected reporting date.'
                    FROM days WHERE report_date NOT IN (SELECT report_date FROM cat2))""",
    "panel_views_series": """SELECT window_end AS time, product_id AS metric, view_count AS value FROM agg
                             WHERE window_end BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'""",
    "panel_views_legend": """SELECT product_id AS metric, MAX(view_count) AS max_value, AVG(view_count) AS mean_value
                             FROM agg WHERE window_end BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'
                             GROUP BY 1""",
    "panel_funnel": """
        SELECT time, metric, value FROM (
          SELECT window_end AS time, 'Views' AS metric, CAST(SUM(view_count) AS BIGINT) AS value FROM agg
          WHERE window_end BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01' GROUP BY window_end
          UNION ALL
          SELECT window_end, 'Add to Cart', CAST(SUM(cart_count) AS BIGINT) FROM agg
          WHERE window_end BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01' GROUP BY window_end
          UNION ALL
          SELECT window_end, 'Purchases', CAST(SUM(purchase_count) AS BIGINT) FROM agg
          WHERE window_end BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01' GROUP BY window_end)""",
    "panel_alert_count": """
        SELECT alert_count, CASE WHEN alert_count >= 5 THEN 'red' WHEN alert_count >= 1 THEN 'orange'
                                 ELSE 'green' END AS status
        FROM (SELECT COUNT(*) AS alert_count FROM alerts
              WHERE created_at BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01')""",
    "panel_alert_log": """
        SELECT product_id, view_count, purchase_count, alert_message, created_at FROM alerts
        WHERE created_at BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'
        ORDER BY created_at DESC, product_id, window_start LIMIT 50""",
    "panel_alert_annotations": """
        SELECT created_at AS time, product_id || ' — Flash Sale Triggered' AS text, 'Flash Sale' AS tags,
               product_id, window_start
        FROM alerts WHERE created_at BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'""",
    "panel_conversion_top10": f"""
        SELECT metric, value, CASE WHEN value >= 0.15 THEN 'green' WHEN value >= 0.05 THEN 'orange'
                                   ELSE 'red' END AS status
        FROM (SELECT product_id AS metric, {_rate('SUM(purchase_count)', 'SUM(view_count)')} AS value
              FROM agg WHERE window_end BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'
              GROUP BY product_id ORDER BY value DESC, metric LIMIT 10)""",
    "panel_daily_top": """SELECT rank, product_id, total_views, total_purchases, conversion_rate FROM report
                          WHERE report_date = DATE '2024-01-15' ORDER BY rank LIMIT 10""",
    "panel_buyers": """SELECT COUNT(*) AS users FROM seg
                       WHERE segment_date = DATE '2024-01-15' AND segment = 'Buyer'""",
    "panel_window_shoppers": """SELECT COUNT(*) AS users FROM seg
                                WHERE segment_date = DATE '2024-01-15' AND segment = 'Window Shopper'""",
    "panel_segment_detail": """
        SELECT segment_date, user_id, segment, total_views, total_purchases,
               CASE segment WHEN 'Buyer' THEN 'green' WHEN 'Window Shopper' THEN 'blue' END AS colour
        FROM seg WHERE segment_date = DATE '2024-01-15'
        ORDER BY total_purchases DESC, total_views DESC, user_id LIMIT 50""",
    "panel_display_names": """
        SELECT 'alert_log' AS panel, 'Product ID, Views, Purchases, Recommendation, Triggered At' AS columns,
               LEAST(50, COUNT(*)) AS rows
        FROM alerts WHERE created_at BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'
        UNION ALL
        SELECT 'daily_top', '#, Product ID, total_views, total_purchases, Conversion Rate', LEAST(10, COUNT(*))
        FROM report WHERE report_date = DATE '2024-01-15'
        UNION ALL
        SELECT 'segment_detail', 'Date, User ID, Segment, total_views, total_purchases, colour', LEAST(50, COUNT(*))
        FROM seg WHERE segment_date = DATE '2024-01-15'""",
    "table_counts": """
        SELECT 'clickstream_events' AS table_name, COUNT(*) AS row_count FROM valid
        UNION ALL SELECT 'product_view_aggregates', COUNT(*) FROM agg
        UNION ALL SELECT 'flash_sale_alerts', COUNT(*) FROM alerts
        UNION ALL SELECT 'user_segments', COUNT(*) FROM seg
        UNION ALL SELECT 'daily_product_report', COUNT(*) FROM report""",
}


SQL["topic_log_first_n"] = """
    SELECT CAST(uid % 3 AS INTEGER) AS "partition", uid AS "offset", event_id, product_id, event_type
    FROM ev ORDER BY 1, 2 LIMIT 5"""
SQL["topic_log_replay"] = """
    SELECT CAST(uid % 3 AS INTEGER) AS "partition", uid AS "offset", event_id, product_id, event_type FROM ev
    WHERE CASE uid % 3 WHEN 0 THEN uid >= 300 WHEN 1 THEN uid >= 500 AND uid < 900 ELSE uid < 600 END"""

SQL["conversion_job"] = f"""
    SELECT 'csv' AS file, report_date, line_no, category || ',' || product_id || ',' || CAST(total_views AS VARCHAR)
           || ',' || CAST(total_purchases AS VARCHAR) || ',' || conversion_rate AS line
    FROM ({SQL['conversion_csv']})
    UNION ALL SELECT 'summary', report_date, line_no, line FROM ({SQL['category_summary_text']})"""

# queries that read files and logs back -> the query whose SQL they must equal
READ_BACK = {
    "top_products_file": "top_products_text",
    "conversion_csv_file": "conversion_csv",
    "conversion_csv_parts": "conversion_csv",
    "category_summary_file": "category_summary_text",
    "flash_sale_audit": "flash_sale",
}


def all_sql() -> dict:
    from cartwheel.plans import stream_catalog
    out = {name: _q(body) for name, body in SQL.items()}
    for name, base in READ_BACK.items():
        out[name] = _q(SQL[base])
    for name, base in stream_catalog.STREAM_ORACLE.items():
        out[name] = _q(SQL[base]) if base in SQL else _q(base)
    return out
