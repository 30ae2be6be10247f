"""Registered queries: one per operator group of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (via the adapter) over their whole extent.
Results are made comparable with an SQL engine: timestamps as TIMESTAMP_NTZ,
decimals as DOUBLE, SMALLINT ranks as INT; clock columns are left out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel import constants as C
from cartwheel.operators import daily, dashboard, decode, quality, windows
from cartwheel.config import StreamSettings
from cartwheel.plans import jobs
from cartwheel.plans import params as P
from cartwheel.plans import tables as TB
from cartwheel.schemas import KEYS, RAW_COLUMNS, WIDE_RAW_EXTRA
from cartwheel.session import scratch_path
from cartwheel.sinks import keyed, reports
from cartwheel.sources import kafka, topic_log
from cartwheel.sources.adapter import wire_from_events
from cartwheel.streaming import job


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ShortType, T.ByteType)):
            c = c.cast("int")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _decoded_wire(spark, sf_dir):
    return decode.decode_events(wire_from_events(TB.events_table(spark, sf_dir)))


# --- decode and quality ---------------------------------------------------

def q_decode_valid(spark, sf_dir):
    valid, _ = decode.validate(_decoded_wire(spark, sf_dir))
    return valid.select(*RAW_COLUMNS)


def q_quarantine(spark, sf_dir):
    _, bad = decode.validate(_decoded_wire(spark, sf_dir))
    return bad.select("event_id", "event_type", "event_time", "reason")


def q_quarantine_reasons(spark, sf_dir):
    """Records damaged by a rule of their offset land in quarantine with a reason."""
    wire = wire_from_events(TB.events_table(spark, sf_dir))
    number = F.col("offset") % 12
    text = F.col("value").cast("string")
    long = F.lit("x" * 70)
    hurt = (F.when(number == 0, F.substring(text, 1, 20))
            .when(number == 1, F.regexp_replace(text, '"timestamp": ?"[^"]*"', '"timestamp":"yesterday"'))
            .when(number == 2, F.regexp_replace(text, '"user_id": ?"[^"]*", ?', ""))
            .when(number == 3, F.regexp_replace(text, '"product_id": ?"[^"]*"', F.concat(F.lit('"product_id":"'), long, F.lit('"'))))
            .otherwise(text))
    damaged = wire.withColumn("value", hurt.cast("binary"))
    _, bad = decode.validate(decode.decode_events(damaged))
    return bad.groupBy("reason").agg(F.count("*").alias("rows"))


def q_json_roundtrip(spark, sf_dir):
    typed = TB.decoded(spark, sf_dir)
    schema = typed.schema
    encoded = kafka.to_json_records(typed, key_column="event_id")
    return kafka.from_json_records(encoded, schema)


def q_topic_first_n(spark, sf_dir):
    first = kafka.first_messages(wire_from_events(TB.events_table(spark, sf_dir)), 5)
    return decode.decode_events(first).select("offset", "event_id", "product_id", "event_type")


def _topic_log(spark, sf_dir):
    """The whole topic in three partitions, delivered in two slices; its path and schema."""
    path = scratch_path(spark, "topic")
    records = wire_from_events(TB.events_table(spark, sf_dir)).withColumn("partition", (F.col("offset") % 3).cast("int"))
    middle = F.col("timestamp") < F.lit(P.AS_OF).cast("timestamp")
    for batch, part in enumerate((middle, ~middle)):
        topic_log.write(records.where(part), path, batch, rows_per_file=5000, parts=6)
    return path, records.schema


def q_topic_log_first_n(spark, sf_dir):
    """The first messages of a stored topic; only the leading file is opened."""
    path, schema = _topic_log(spark, sf_dir)
    first = topic_log.first_messages(spark, path, schema, 5)
    return decode.decode_events(first).select("partition", "offset", "event_id", "product_id", "event_type")


def q_topic_log_replay(spark, sf_dir):
    """A bounded replay by partition offsets; files without such offsets are not opened."""
    path, schema = _topic_log(spark, sf_dir)
    rows = topic_log.read_replay(spark, path, schema, starting={0: 300, 1: 500}, ending={1: 900, 2: 600})
    return decode.decode_events(rows).select("partition", "offset", "event_id", "product_id", "event_type")


def q_raw_wide(spark, sf_dir):
    valid, _ = decode.validate(_decoded_wire(spark, sf_dir))
    return valid.select(*RAW_COLUMNS, *WIDE_RAW_EXTRA)


def q_quality_duplicates(spark, sf_dir):
    tables = {
        "clickstream_events": TB.stored_events(spark, sf_dir),
        "product_view_aggregates": TB.stored_aggregates(spark, sf_dir),
        "flash_sale_alerts": TB.stored_alerts(spark, sf_dir),
        "user_segments": TB.stored_segments(spark, sf_dir),
        "daily_product_report": TB.stored_report(spark, sf_dir),
    }
    return quality.key_report(tables, KEYS)


def q_rate_overflow(spark, sf_dir):
    counts = daily.product_day_counts(TB.raw_events(spark, sf_dir), P.START, P.END)
    from cartwheel.functions.rates import conversion_rate
    rated = counts.withColumn("conversion_rate", conversion_rate("total_purchases", "total_views"))
    return quality.rate_fits(rated)


def q_segments_domain(spark, sf_dir):
    return quality.segment_domain(TB.segments(spark, sf_dir))


# --- windows and alerts ----------------------------------------------------

def q_sliding_counts(spark, sf_dir):
    return TB.aggregates(spark, sf_dir)


def q_flash_sale(spark, sf_dir):
    return TB.alert_rows(spark, sf_dir).drop("created_at")


def q_window_event_type_counts(spark, sf_dir):
    return windows.window_event_type_counts(TB.decoded(spark, sf_dir), P.D1_WINDOW, P.D1_SLIDE)


def q_window_conversion(spark, sf_dir):
    return windows.with_window_conversion(TB.aggregates(spark, sf_dir))


# --- daily jobs -------------------------------------------------------------

def q_user_segments(spark, sf_dir):
    return TB.segments(spark, sf_dir)


def q_segments_three_way(spark, sf_dir):
    return TB.segments(spark, sf_dir, three_way=True)


def q_segment_share(spark, sf_dir):
    return daily.segment_share(TB.segments(spark, sf_dir, three_way=True))


def q_daily_top_products(spark, sf_dir):
    return TB.daily_report(spark, sf_dir)


def q_conversion_by_product(spark, sf_dir):
    return TB.conversion(spark, sf_dir)


def q_category_conversion(spark, sf_dir):
    return daily.category_conversion(TB.conversion(spark, sf_dir))


def q_category_map_conversion(spark, sf_dir):
    return daily.category_map_conversion(TB.raw_events(spark, sf_dir), P.START, P.END,
                                         daily.catalogue(spark))


def q_top_from_aggregates(spark, sf_dir):
    return daily.top_from_aggregates(TB.aggregates(spark, sf_dir))


# --- reports ----------------------------------------------------------------

def q_top_products_text(spark, sf_dir):
    days = reports.report_days(spark, P.START, P.END)
    return reports.top_products_lines(TB.daily_report(spark, sf_dir), days)


def q_conversion_csv(spark, sf_dir):
    return reports.conversion_csv_rows(TB.conversion(spark, sf_dir))


def q_category_summary_text(spark, sf_dir):
    days = reports.report_days(spark, P.START, P.END)
    cats = daily.category_conversion(TB.conversion(spark, sf_dir))
    return reports.category_summary_lines(cats, days)


def _written_in_two_runs(spark, frame: DataFrame, write, name: str) -> str:
    """Writes the dates before and from the middle in two runs, as two scheduled runs would."""
    path = scratch_path(spark, name)
    middle = F.lit(P.AS_OF).cast("date")
    write(frame.where(F.col("report_date") < middle), path)
    write(frame.where(F.col("report_date") >= middle), path)
    return path


def _numbered(stored: DataFrame) -> DataFrame:
    """``line_no``: the place of a line in its date's file."""
    order = Window.partitionBy("report_date").orderBy("_at")
    return stored.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "line_no", F.row_number().over(order)).drop("_at")


def _text_file(spark, lines: DataFrame, name: str) -> DataFrame:
    path = _written_in_two_runs(spark, lines, reports.write_text, name)
    return _numbered(spark.read.text(path)).select("report_date", "line_no", F.col("value").alias("line"))


def q_top_products_file(spark, sf_dir):
    """K7: the text files of all dates after two runs."""
    return _text_file(spark, q_top_products_text(spark, sf_dir), "top-products-text")


def q_category_summary_file(spark, sf_dir):
    """K8: the text files of all dates after two runs."""
    return _text_file(spark, q_category_summary_text(spark, sf_dir), "category-summary-text")


def q_conversion_csv_file(spark, sf_dir):
    """K6: the CSV files of all dates after two runs."""
    rows = q_conversion_csv(spark, sf_dir)
    path = _written_in_two_runs(spark, rows, reports.write_csv, "conversion-csv")
    schema = T.StructType([f for f in rows.schema.fields if f.name not in ("report_date", "line_no")])
    return _numbered(spark.read.option("header", True).schema(schema).csv(path)).select(*rows.columns)


def q_conversion_csv_parts(spark, sf_dir):
    """K6, L2: the CSV rows of all dates from several files a date after two runs, numbered in file order."""
    conversion = TB.conversion(spark, sf_dir)
    path = _written_in_two_runs(spark, conversion, lambda rows, at: reports.write_csv_parts(rows, at, rows_per_file=8),
                                "conversion-csv-parts")
    schema = "category string, product_id string, total_views long, total_purchases long, conversion_rate string"
    return reports.read_csv_parts(spark, path, schema).select("report_date", "line_no", *C.CSV_HEADER)


def q_conversion_job(spark, sf_dir):
    """The conversion job back-fills every day; the lines of both its files read back."""
    out = scratch_path(spark, "conversion-job")
    jobs.conversion_report(spark, TB.raw_events(spark, sf_dir), out, P.START, P.END, backfill=True)
    rows = _numbered(spark.read.option("header", True).schema(", ".join(f"{c} string" for c in C.CSV_HEADER)).csv(
        f"{out}/conversion_rates"))
    text = _numbered(spark.read.text(f"{out}/category_conversion_summary"))
    return (rows.select(F.lit("csv").alias("file"), "report_date", "line_no", F.concat_ws(",", *C.CSV_HEADER).alias("line"))
            .unionAll(text.select(F.lit("summary"), "report_date", "line_no", "value")))


def _offset_events(spark, sf_dir):
    """The scheduled interval that starts at six in the morning of the dashboard's day."""
    start = dt.datetime.fromisoformat(P.AS_OF) + dt.timedelta(hours=6)
    return TB.raw_events(spark, sf_dir), start, start + dt.timedelta(days=1)


def q_report_offset_interval(spark, sf_dir):
    """One report for an interval across midnight, dated by its start, written and read back."""
    events, start, end = _offset_events(spark, sf_dir)
    stored = jobs.daily_product_report(spark, events, scratch_path(spark, "offset-report"), None, start, end)
    return stored.select("report_date", "rank", "product_id", "total_views", "total_purchases", "conversion_rate")


def q_segments_offset_interval(spark, sf_dir):
    """One set of segments for an interval across midnight, dated by its start, written and read back."""
    events, start, end = _offset_events(spark, sf_dir)
    stored = jobs.user_segmentation(spark, events, scratch_path(spark, "offset-segments"), start, end)
    return stored.select("segment_date", "user_id", "segment", "total_views", "total_purchases")


def q_default_stamps(spark, sf_dir):
    """Stored rows carry filled counts and stamps of the run, whatever the clock says."""
    segments = TB.segments(spark, sf_dir)
    gaps = segments.withColumn("total_purchases", F.nullif("total_purchases", F.lit(0)))
    stored = jobs.with_defaults(gaps, counts=("total_purchases",), stamps=("created_at",))
    recent = F.col("created_at").between(F.current_timestamp() - F.expr("interval 1 day"), F.current_timestamp())
    return stored.groupBy("segment_date").agg(
        F.count("*").alias("rows"), F.sum("total_purchases").alias("total_purchases"),
        F.count_if(F.col("total_purchases").isNull()).alias("null_counts"), F.count_if(~recent).alias("odd_stamps"))


def q_flash_sale_audit(spark, sf_dir):
    """The audit job's rule over the final aggregates read back from their log (not latched)."""
    path = scratch_path(spark, "audit-aggregates")
    keyed.upsert(job.with_window_date(TB.aggregates(spark, sf_dir)), path, 0, partition_by=(keyed.WINDOW_DATE,))
    stored = keyed.current(spark, path, KEYS["product_view_aggregates"])
    settings = StreamSettings(min_views=P.MIN_VIEWS, max_purchases=P.MAX_PURCHASES)
    return jobs.flash_sale_audit(spark, stored, settings, show=False).drop("created_at")


# --- dashboard panels -------------------------------------------------------

def q_panel_views_series(spark, sf_dir):
    return dashboard.views_series(TB.stored_aggregates(spark, sf_dir, P.START, P.END), P.START, P.END)


def q_panel_views_legend(spark, sf_dir):
    return dashboard.views_legend(dashboard.views_series(TB.stored_aggregates(spark, sf_dir, P.START, P.END), P.START, P.END))


def q_panel_funnel(spark, sf_dir):
    return dashboard.funnel(TB.stored_aggregates(spark, sf_dir, P.START, P.END), P.START, P.END)


def q_panel_alert_count(spark, sf_dir):
    return dashboard.alert_count(TB.stored_alerts(spark, sf_dir, P.START, P.END), P.START, P.END)


def q_panel_alert_log(spark, sf_dir):
    return dashboard.alert_log(TB.stored_alerts(spark, sf_dir, P.START, P.END), P.START, P.END)


def q_panel_alert_annotations(spark, sf_dir):
    return dashboard.alert_annotations(TB.stored_alerts(spark, sf_dir, P.START, P.END), P.START, P.END)


def q_panel_conversion_top10(spark, sf_dir):
    return dashboard.conversion_top(TB.stored_aggregates(spark, sf_dir, P.START, P.END), P.START, P.END)


def q_panel_daily_top(spark, sf_dir):
    return dashboard.daily_top(TB.stored_report(spark, sf_dir), P.AS_OF)


def q_panel_buyers(spark, sf_dir):
    return dashboard.segment_count(TB.stored_segments(spark, sf_dir), C.SEGMENT_BUYER, P.AS_OF)


def q_panel_window_shoppers(spark, sf_dir):
    return dashboard.segment_count(TB.stored_segments(spark, sf_dir), C.SEGMENT_WINDOW_SHOPPER, P.AS_OF)


def q_panel_segment_detail(spark, sf_dir):
    return dashboard.segment_detail(TB.stored_segments(spark, sf_dir), P.AS_OF)


def q_panel_display_names(spark, sf_dir):
    """The tables of the dashboard under the names that it shows (columns and rows of each)."""
    shown = {
        "alert_log": dashboard.alert_log(TB.stored_alerts(spark, sf_dir, P.START, P.END), P.START, P.END, display=True),
        "daily_top": dashboard.rename_for_display(dashboard.daily_top(TB.stored_report(spark, sf_dir), P.AS_OF)),
        "segment_detail": dashboard.rename_for_display(dashboard.segment_detail(TB.stored_segments(spark, sf_dir), P.AS_OF)),
    }
    parts = [df.agg(F.lit(name).alias("panel"), F.lit(", ".join(df.columns)).alias("columns"), F.count("*").alias("rows"))
             for name, df in shown.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def q_table_counts(spark, sf_dir):
    return dashboard.table_counts({
        "clickstream_events": TB.stored_events(spark, sf_dir),
        "product_view_aggregates": TB.stored_aggregates(spark, sf_dir),
        "flash_sale_alerts": TB.stored_alerts(spark, sf_dir),
        "user_segments": TB.stored_segments(spark, sf_dir),
        "daily_product_report": TB.stored_report(spark, sf_dir),
    })


BATCH_QUERIES = {
    "decode_valid": q_decode_valid,
    "quarantine": q_quarantine,
    "json_roundtrip": q_json_roundtrip,
    "topic_first_n": q_topic_first_n,
    "topic_log_first_n": q_topic_log_first_n,
    "topic_log_replay": q_topic_log_replay,
    "raw_wide": q_raw_wide,
    "quality_duplicates": q_quality_duplicates,
    "rate_overflow": q_rate_overflow,
    "segments_domain": q_segments_domain,
    "sliding_counts": q_sliding_counts,
    "flash_sale": q_flash_sale,
    "window_event_type_counts": q_window_event_type_counts,
    "window_conversion": q_window_conversion,
    "user_segments": q_user_segments,
    "segments_three_way": q_segments_three_way,
    "segment_share": q_segment_share,
    "daily_top_products": q_daily_top_products,
    "conversion_by_product": q_conversion_by_product,
    "category_conversion": q_category_conversion,
    "category_map_conversion": q_category_map_conversion,
    "top_from_aggregates": q_top_from_aggregates,
    "top_products_text": q_top_products_text,
    "conversion_csv": q_conversion_csv,
    "category_summary_text": q_category_summary_text,
    "top_products_file": q_top_products_file,
    "conversion_csv_file": q_conversion_csv_file,
    "category_summary_file": q_category_summary_file,
    "conversion_csv_parts": q_conversion_csv_parts,
    "conversion_job": q_conversion_job,
    "report_offset_interval": q_report_offset_interval,
    "segments_offset_interval": q_segments_offset_interval,
    "default_stamps": q_default_stamps,
    "flash_sale_audit": q_flash_sale_audit,
    "quarantine_reasons": q_quarantine_reasons,
    "panel_views_series": q_panel_views_series,
    "panel_views_legend": q_panel_views_legend,
    "panel_funnel": q_panel_funnel,
    "panel_alert_count": q_panel_alert_count,
    "panel_alert_log": q_panel_alert_log,
    "panel_alert_annotations": q_panel_alert_annotations,
    "panel_conversion_top10": q_panel_conversion_top10,
    "panel_daily_top": q_panel_daily_top,
    "panel_buyers": q_panel_buyers,
    "panel_window_shoppers": q_panel_window_shoppers,
    "panel_segment_detail": q_panel_segment_detail,
    "panel_display_names": q_panel_display_names,
    "table_counts": q_table_counts,
}


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # days and windows are UTC: the library assumes a UTC session
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return comparable(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict:
    from cartwheel.plans import stream_catalog
    out = {name: _wrap(fn) for name, fn in BATCH_QUERIES.items()}
    out.update({name: _wrap(fn) for name, fn in stream_catalog.STREAM_QUERIES.items()})
    return out
