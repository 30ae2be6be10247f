"""Registered queries that run the streaming job and the table writers on the test tables.

One replay run per (session, data folder) is shared by the streaming queries: the
wire records of the whole ``events`` table are dealt to slices of
``params.DAYS_PER_BATCH`` days, fed one slice per pass of the job, and the first slice
is delivered a second time at the end (duplicates for the raw table, late rows for
the windows). Output folders are new folders under the shared checkpoint root.
"""

from __future__ import annotations

from unittest import mock

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import StreamSettings
from cartwheel.operators import daily, windows
from cartwheel.plans import params as P
from cartwheel.plans import tables as TB
from cartwheel.schemas import KEYS, RAW_COLUMNS
from cartwheel.session import scratch_path
from cartwheel.sinks import keyed, partitions
from cartwheel.sources import kafka
from cartwheel.sources.adapter import wire_from_events
from cartwheel.sources.tables import read_events_range, report_rows
from cartwheel.streaming import job, progress, replay, state

SETTINGS = StreamSettings(window=P.WINDOW, slide=P.SLIDE, watermark="2 minutes",
                          min_views=P.MIN_VIEWS, max_purchases=P.MAX_PURCHASES)

_RUNS: dict = {}


def _metered(spark, folder: str, run) -> dict:
    """What ``run`` starts, awaited; the progress of its micro-batches goes to ``folder``."""
    listener = progress.MetricsTable(spark, folder)
    spark.streams.addListener(listener)
    try:
        started = run()
        job.await_all(started)
        progress.settle(spark)
    finally:
        spark.streams.removeListener(listener)
    return started


def replay_run(spark: SparkSession, sf_dir: str) -> dict:
    """Run the streaming job over the replayed records once; cache its output folders."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "replay")
    records = wire_from_events(TB.events_table(spark, sf_dir))
    slices = replay.deal_slices(records, f"{root}/staged", P.START, P.END, P.DAYS_PER_BATCH)
    for place, number in enumerate(replay.deliveries(slices, redeliver_first=True)):
        replay.put_slice(spark, f"{root}/staged", f"{root}/source", number, place, records.schema)
        stream = replay.read_slices(spark, f"{root}/source", records.schema, files_per_trigger=None)
        # a pass is one batch of each query, and perhaps one without data
        started = _metered(spark, f"{root}/metrics/pass={place}", lambda: job.start(
            spark, stream, f"{root}/out", SETTINGS, trigger={"availableNow": True}))
    run = {"paths": started["paths"], "metrics": f"{root}/metrics"}
    _RUNS[key] = run
    return run


def forget_runs() -> None:
    """Drop the cached replay runs: the next ``replay_run`` replays again into new folders."""
    _RUNS.clear()


def q_raw_insert_ignore(spark, sf_dir):
    """Raw table after the replay: every valid event once, though the first slice came twice."""
    paths = replay_run(spark, sf_dir)["paths"]
    return keyed.union_of_slices(spark, paths.raw).select(*RAW_COLUMNS)


def q_sliding_counts_stream(spark, sf_dir):
    """Aggregates table of the stream: update mode + watermark + upsert; equals the batch counts."""
    paths = replay_run(spark, sf_dir)["paths"]
    return keyed.current(spark, paths.aggregates, KEYS["product_view_aggregates"]).drop("computed_at")


def q_flash_sale_latched(spark, sf_dir):
    """Alerts table of the stream: rows stay once written, with the values of their last alerting batch."""
    paths = replay_run(spark, sf_dir)["paths"]
    return keyed.current(spark, paths.alerts, KEYS["flash_sale_alerts"]).drop("created_at")


def q_replay_equals_batch(spark, sf_dir):
    """Daily top products computed from the stream-written raw table (Kappa replay, T13, S4)."""
    paths = replay_run(spark, sf_dir)["paths"]
    raw = read_events_range(spark, paths.raw, P.START, P.END)
    return daily.daily_top_products(raw, P.START, P.END)


def _passes(spark, sf_dir) -> DataFrame:
    """Stored progress of the two main queries by pass, one row for each micro-batch."""
    found = progress.read_metrics(spark, replay_run(spark, sf_dir)["metrics"])
    return found.where(F.col("query_name").isin("raw_events", "window_aggregates"))


def q_late_rows_dropped(spark, sf_dir):
    """Per pass of the window query: input rows, and whether the watermark dropped any."""
    mine = _passes(spark, sf_dir).where(F.col("query_name") == "window_aggregates")
    return mine.groupBy("pass").agg(F.sum("num_input_rows").alias("num_input_rows"),
                                    (F.max("rows_dropped_by_watermark") > 0).alias("late_rows_dropped"))


def q_progress_metrics(spark, sf_dir):
    """Input rows of both queries per pass, as their progress tells (T12); rates depend on the machine."""
    return _passes(spark, sf_dir).groupBy("query_name", "pass").agg(F.sum("num_input_rows").alias("num_input_rows"))


def q_aggregates_upsert(spark, sf_dir):
    """Upsert log replayed: batch 0 = first half, batch 1 = windows touched later with their
    full counts, batch 1 delivered twice; the current view equals the full counts (K2, K12)."""
    root = scratch_path(spark, "upsert")
    events = TB.decoded(spark, sf_dir)
    mid = "2024-01-16"
    first = windows.sliding_counts(events.where(F.col("event_time") < F.lit(mid).cast("timestamp_ntz")),
                                   P.WINDOW, P.SLIDE)
    later_keys = windows.sliding_counts(
        events.where(F.col("event_time") >= F.lit(mid).cast("timestamp_ntz")), P.WINDOW, P.SLIDE
    ).select("window_start", "window_end", "product_id")
    full = windows.sliding_counts(events, P.WINDOW, P.SLIDE)
    second = full.join(later_keys, ["window_start", "window_end", "product_id"], "left_semi")
    stamp = F.current_timestamp().alias("computed_at")
    by_date = (keyed.WINDOW_DATE,)
    keyed.upsert(job.with_window_date(first.select("*", stamp)), root, 0, partition_by=by_date)
    keyed.upsert(job.with_window_date(second.select("*", stamp)), root, 1, partition_by=by_date)
    # replayed batch: same folders, same result
    keyed.upsert(job.with_window_date(second.select("*", stamp)), root, 1, partition_by=by_date)
    return keyed.current(spark, root, KEYS["product_view_aggregates"]).drop("computed_at")


def _replace_flow(spark, df: DataFrame, date_col: str, name: str) -> DataFrame:
    """Write all dates, plant a stale copy of the last day under the next (empty) date,
    then re-run the empty date: the stale rows must go (K4, K5)."""
    path = scratch_path(spark, name)
    partitions.replace_dates(spark, df, path, date_col, P.START, P.END)
    last_day = F.lit("2024-01-30").cast("date")
    stale = df.where(F.col(date_col) == last_day).withColumn(date_col, F.date_add(F.col(date_col), 1))
    partitions.replace_dates(spark, stale, path, date_col, "2024-01-31", "2024-02-01")
    empty = df.where(F.col(date_col) > F.lit("2024-01-30").cast("date"))
    partitions.replace_dates(spark, empty, path, date_col, "2024-01-31", "2024-02-01")
    return spark.read.parquet(path)


def q_user_segments_replace(spark, sf_dir):
    table = _replace_flow(spark, TB.segments(spark, sf_dir), "segment_date", "user_segments")
    return table.select("segment_date", "user_id", "segment", "total_views", "total_purchases")


def q_daily_report_replace(spark, sf_dir):
    table = _replace_flow(spark, TB.daily_report(spark, sf_dir), "report_date", "daily_product_report")
    return table.select("report_date", "rank", "product_id", "total_views", "total_purchases",
                        "conversion_rate")


def q_report_readback(spark, sf_dir):
    """Rows of one report date in rank order, read back from the stored report."""
    table = _replace_flow(spark, TB.daily_report(spark, sf_dir), "report_date", "daily_product_report")
    return report_rows(table, P.AS_OF).select("rank", "product_id", "total_views", "total_purchases",
                                              "conversion_rate")


def q_raw_cross_date_ids(spark, sf_dir):
    """K1: every record comes again a year later under its old id; the raw table keeps the first."""
    root = scratch_path(spark, "cross-date")
    records = wire_from_events(TB.events_table(spark, sf_dir))
    stamp = "\"timestamp\":\"2024-"
    moved = records.withColumn("value", F.regexp_replace(
        F.col("value").cast("string"), stamp, stamp.replace("2024", "2025")).cast("binary"))
    for place, rows in enumerate((records, moved)):
        rows.write.parquet(f"{root}/source/part={place:05d}")
        stream = replay.read_slices(spark, f"{root}/source", records.schema, files_per_trigger=None)
        started = job.start(spark, stream, f"{root}/out", SETTINGS, trigger={"availableNow": True})
        job.await_all(started)
    return keyed.union_of_slices(spark, started["paths"].raw).select(*RAW_COLUMNS)


def q_replay_twice(spark, sf_dir):
    """A second run with other borders over the tables of the first; the raw table and the aggregates
    hold what one run gives (raw rows and window rows counted by table)."""
    root = scratch_path(spark, "twice")
    records = wire_from_events(TB.events_table(spark, sf_dir))
    for run, days in (("", 16), ("again", 31)):
        slices = replay.deal_slices(records, f"{root}/staged{run}", P.START, P.END, days)
        for place, number in enumerate(replay.deliveries(slices)):
            replay.put_slice(spark, f"{root}/staged{run}", f"{root}/source{run}", number, place, records.schema)
            stream = replay.read_slices(spark, f"{root}/source{run}", records.schema, files_per_trigger=None)
            started = job.start(spark, stream, f"{root}/out", SETTINGS, trigger={"availableNow": True}, run=run)
            job.await_all(started)
    paths = started["paths"]
    raw = keyed.union_of_slices(spark, paths.raw)
    counts = keyed.current(spark, paths.aggregates, KEYS["product_view_aggregates"])
    return (raw.agg(F.lit("raw").alias("name"), F.count("*").alias("rows"), F.countDistinct("event_id").alias("total"))
            .unionAll(counts.agg(F.lit("aggregates"), F.count("*"), F.sum(
                F.col("view_count") + F.col("cart_count") + F.col("purchase_count")))))


def pane_run(spark: SparkSession, sf_dir: str):
    """The replay of ``replay_run`` with shared panes, run once; its paths."""
    key = (spark.sparkContext.applicationId, sf_dir, "panes")
    if key not in _RUNS:
        root = scratch_path(spark, "panes")
        records = wire_from_events(TB.events_table(spark, sf_dir))
        slices = replay.deal_slices(records, f"{root}/staged", P.START, P.END, P.DAYS_PER_BATCH)
        for place, number in enumerate(replay.deliveries(slices, redeliver_first=True)):
            replay.put_slice(spark, f"{root}/staged", f"{root}/source", number, place, records.schema)
            stream = replay.read_slices(spark, f"{root}/source", records.schema, files_per_trigger=None)
            started = job.start(spark, stream, f"{root}/out", SETTINGS, trigger={"availableNow": True}, shared_panes=True)
            job.await_all(started)
        _RUNS[key] = started["paths"]
    return _RUNS[key]


def q_sliding_counts_panes(spark, sf_dir):
    """The aggregates of the replay with shared panes; the same windows as with a state row for each window."""
    paths = pane_run(spark, sf_dir)
    return keyed.current(spark, paths.aggregates, KEYS["product_view_aggregates"]).drop("computed_at")


def q_flash_sale_panes(spark, sf_dir):
    """The latched alerts of the replay with shared panes."""
    paths = pane_run(spark, sf_dir)
    return keyed.current(spark, paths.alerts, KEYS["flash_sale_alerts"]).drop("created_at")


def q_pane_state_rows(spark, sf_dir):
    """The state of the replay with shared panes, one row per product and slide of the open windows."""
    return state.open_panes(spark, pane_run(spark, sf_dir).checkpoint("aggregates"))


def q_window_state_rows(spark, sf_dir):
    """The window query's state after the replay, read from its checkpoint: the windows still open."""
    paths = replay_run(spark, sf_dir)["paths"]
    return state.open_windows(spark, paths.checkpoint("aggregates"))


def q_observed_metrics(spark, sf_dir):
    """What the stream observed by pass. A tenth of the records has no time, and the second pass brings bad
    records alone, so its batch of valid rows is empty."""
    root = scratch_path(spark, "observed")
    records = wire_from_events(TB.events_table(spark, sf_dir)).withColumn("value", F.expr(
        "CASE WHEN offset % 10 = 0 THEN cast(replace(cast(value AS string), '\"timestamp\":', '\"stamp\":') AS binary) ELSE value END"))
    bad = F.col("value").cast("string").contains('"event_type":"error"') | (F.col("offset") % 10 == 0)
    part = F.when(bad & (F.col("offset") % 3 == 0), 1).otherwise(F.when(F.col("offset") % 2 == 0, 0).otherwise(2))
    records.withColumn("part", part).write.partitionBy("part").parquet(f"{root}/staged")
    schema = records.schema
    for place in range(3):
        spark.read.schema(schema).parquet(f"{root}/staged/part={place}").write.parquet(f"{root}/source/part={place:05d}")
        stream = replay.read_slices(spark, f"{root}/source", schema, files_per_trigger=None)
        _metered(spark, f"{root}/metrics/pass={place}", lambda: job.start(
            spark, stream, f"{root}/out", SETTINGS, trigger={"availableNow": True}))
    seen = progress.read_metrics(spark, f"{root}/metrics").where(F.col("query_name") == "raw_events")
    names = ("rows", "valid", "without_time", "view", "add_to_cart", "purchase")
    return seen.groupBy("pass").agg(*[F.sum(F.col("observed")["decoded"][n]).alias(n) for n in names])


def q_failing_query_stops_all(spark, sf_dir):
    """A planted failure of the second query's sink; which query failed, which were stopped, the error class."""
    root = scratch_path(spark, "supervised")
    records = wire_from_events(TB.events_table(spark, sf_dir))
    records.write.parquet(f"{root}/source/part=00000")
    stream = replay.read_slices(spark, f"{root}/source", records.schema, files_per_trigger=None)

    def failing(*_, **__):
        def write(batch, batch_id):
            raise OSError("planted: the sink is down")
        return write

    seen = progress.Supervision()
    spark.streams.addListener(seen)
    try:
        with mock.patch.object(job, "aggregate_batch_writer", failing):
            started = job.start(spark, stream, f"{root}/out", SETTINGS, trigger={"processingTime": "1 second"})
            try:
                job.await_all(started)
                raise AssertionError("the planted failure did not end the job")
            except StreamingQueryException as error:
                if "planted: the sink is down" not in str(error):
                    raise
        progress.settle(spark)
    finally:
        spark.streams.removeListener(seen)
    return spark.createDataFrame(seen.ended, "query_name string, outcome string, error_class string")


def q_json_stream_roundtrip(spark, sf_dir):
    """The events as a stream into JSON files, with a restart between two deliveries and one after the commit of
    the second batch was lost, so that it runs again; every event is there once, with its types."""
    root = scratch_path(spark, "json-stream")
    events = TB.decoded(spark, sf_dir)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    events.withColumn("half", half).write.partitionBy("half").parquet(f"{root}/staged")
    schema = events.schema
    checkpoint = f"{root}/checkpoint"

    def run():
        stream = replay.read_slices(spark, f"{root}/source", schema, files_per_trigger=None)
        query = kafka.write_json_files(stream, f"{root}/json", checkpoint, {"availableNow": True})
        query.awaitTermination()

    for part in range(2):
        spark.read.schema(schema).parquet(f"{root}/staged/half={part}").write.parquet(f"{root}/source/part={part:05d}")
        run()
    lost = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/1")
    if not lost.getFileSystem(spark._jsc.hadoopConfiguration()).delete(lost, False):
        raise AssertionError("the second batch has no commit")
    run()
    return kafka.read_json_files(spark, f"{root}/json", schema)


def _copies(spark, sf_dir) -> DataFrame:
    """Every record three times with its own content: ``batch, value, partition, offset``. The second copy comes in the same
    batch, before the first or after it; the third in the next batch, with the least offset of all."""
    records = wire_from_events(TB.events_table(spark, sf_dir))
    number = F.col("offset")
    copy = F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("copy")
    told = F.expr("replace(cast(value AS string), '\"user_id\":\"USER', concat('\"user_id\":\"COPY', cast(copy AS string)))")
    return records.select("value", "timestamp", number.alias("n"), copy).select(
        ((F.col("n") % 2) + F.when(F.col("copy") == 2, 1).otherwise(0)).cast("int").alias("batch"),
        told.cast("binary").alias("value"), "timestamp", (F.col("n") % 3).cast("int").alias("partition"),
        F.expr("CASE WHEN copy = 2 THEN -n - 1 ELSE 3 * n + CASE WHEN copy = 1 THEN n % 2 * 2 - 1 ELSE 0 END END").alias("offset"))


def q_raw_first_writer(spark, sf_dir):
    """K1: copies of an id with other content, inside a batch and in the next one; the first writer's row stays."""
    root = scratch_path(spark, "first-writer")
    copies = _copies(spark, sf_dir)
    copies.write.partitionBy("batch").parquet(f"{root}/staged")
    schema = copies.drop("batch").schema
    for batch in range(3):
        spark.read.schema(schema).parquet(f"{root}/staged/batch={batch}").write.parquet(f"{root}/source/part={batch:05d}")
        stream = replay.read_slices(spark, f"{root}/source", schema, files_per_trigger=None)
        started = job.start(spark, stream, f"{root}/out", SETTINGS, trigger={"availableNow": True})
        job.await_all(started)
    return keyed.union_of_slices(spark, started["paths"].raw).select(*RAW_COLUMNS)


def q_rerun_after_crash(spark, sf_dir):
    """The raw write of the second batch fails between write and commit, and has left rows under a date that the
    second try does not write. Readers see the first batch until the restart, and then every event once."""
    root = scratch_path(spark, "crash")
    records = wire_from_events(TB.events_table(spark, sf_dir))
    slices = replay.deal_slices(records, f"{root}/staged", P.START, P.END, 16)
    commit = keyed.commit_batch

    def crash(session, table, batch_id):
        if table.endswith("clickstream_events") and batch_id == 1:
            rows = session.read.parquet(f"{table}/event_date=*/batch_id=1")
            rows.limit(100).write.parquet(f"{table}/event_date=2030-01-01/batch_id=1")
            raise RuntimeError("planted between write and commit")
        commit(session, table, batch_id)

    def run():
        stream = replay.read_slices(spark, f"{root}/source", records.schema, files_per_trigger=None)
        started = job.start(spark, stream, f"{root}/out", SETTINGS, trigger={"availableNow": True})
        job.await_all(started)
        return started["paths"]

    for place in range(slices):
        replay.put_slice(spark, f"{root}/staged", f"{root}/source", place, place, records.schema)
        if place == 1:
            before = keyed.union_of_slices(spark, paths.raw).count()
            with mock.patch.object(keyed, "commit_batch", crash):
                try:
                    run()
                    raise AssertionError("the planted failure did not end the job")
                except StreamingQueryException as error:
                    if "planted between write and commit" not in str(error):
                        raise
            if keyed.union_of_slices(spark, paths.raw).count() != before:
                raise AssertionError("rows of an uncommitted batch are seen")
        paths = run()
    return keyed.union_of_slices(spark, paths.raw).select(*RAW_COLUMNS)


STREAM_QUERIES = {
    "json_stream_roundtrip": q_json_stream_roundtrip,
    "sliding_counts_panes": q_sliding_counts_panes,
    "flash_sale_panes": q_flash_sale_panes,
    "pane_state_rows": q_pane_state_rows,
    "window_state_rows": q_window_state_rows,
    "observed_metrics": q_observed_metrics,
    "failing_query_stops_all": q_failing_query_stops_all,
    "raw_first_writer": q_raw_first_writer,
    "rerun_after_crash": q_rerun_after_crash,
    "replay_twice": q_replay_twice,
    "raw_cross_date_ids": q_raw_cross_date_ids,
    "raw_insert_ignore": q_raw_insert_ignore,
    "sliding_counts_stream": q_sliding_counts_stream,
    "flash_sale_latched": q_flash_sale_latched,
    "replay_equals_batch": q_replay_equals_batch,
    "late_rows_dropped": q_late_rows_dropped,
    "progress_metrics": q_progress_metrics,
    "aggregates_upsert": q_aggregates_upsert,
    "user_segments_replace": q_user_segments_replace,
    "daily_report_replace": q_daily_report_replace,
    "report_readback": q_report_readback,
}

_LATCHED = """
SELECT product_id, view_count, purchase_count, window_start, window_end,
       'High interest detected — consider launching a Flash Sale or targeted discount.' AS alert_message
FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, product_id ORDER BY slice DESC) AS rn
  FROM (
    SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, product_id, slice,
           CAST(SUM(v) OVER w AS BIGINT) AS view_count, CAST(SUM(p) OVER w AS BIGINT) AS purchase_count
    FROM (
      SELECT window_start, product_id, slice,
             COUNT(*) FILTER (WHERE event_type = 'view') AS v,
             COUNT(*) FILTER (WHERE event_type = 'purchase') AS p
      FROM (SELECT *, date_trunc('hour', event_time) - to_hours(i) AS window_start,
                   (CAST(event_time AS DATE) - DATE '2024-01-01') // 8 AS slice
            FROM (SELECT *, unnest(range(0, 6)) AS i FROM ev))
      GROUP BY 1, 2, 3)
    WINDOW w AS (PARTITION BY window_start, product_id ORDER BY slice)
  )
  WHERE view_count > 2 AND purchase_count < 1)
WHERE rn = 1
"""

_PASSES = """
SELECT slice AS pass, COUNT(*) AS n, MAX(event_time) AS latest, MIN(event_time) AS earliest FROM
  (SELECT *, (CAST(event_time AS DATE) - DATE '2024-01-01') // 8 AS slice FROM ev) GROUP BY slice
UNION ALL
SELECT 4, COUNT(*), MAX(event_time), MIN(event_time) FROM ev WHERE event_time < TIMESTAMP '2024-01-09'
"""

# a window ends six hours after its start, and windows start every hour
_LATE = f"""
SELECT CAST(pass AS INTEGER) AS pass, CAST(n AS BIGINT) AS num_input_rows,
       coalesce(date_trunc('hour', earliest) + INTERVAL 1 HOUR <= MAX(latest) OVER (
         ORDER BY pass ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 MINUTE, FALSE) AS late_rows_dropped
FROM ({_PASSES})
"""

_PROGRESS = f"""
SELECT query_name, CAST(pass AS INTEGER) AS pass, CAST(n AS BIGINT) AS num_input_rows
FROM ({_PASSES}), (SELECT unnest(['raw_events', 'window_aggregates']) AS query_name)
"""

# query name -> key of the batch SQL it must equal, or its own SQL
STREAM_ORACLE = {
    "json_stream_roundtrip": "json_roundtrip",
    "sliding_counts_panes": "sliding_counts",
    "flash_sale_panes": _LATCHED,
    "pane_state_rows": """
        SELECT date_trunc('hour', event_time) AS pane_start, product_id,
               COUNT(*) FILTER (WHERE event_type = 'view') AS view_count,
               COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_count,
               COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase_count, MAX(event_time) AS latest
        FROM ev GROUP BY 1, 2
        HAVING date_trunc('hour', ANY_VALUE(event_time)) + INTERVAL 6 HOUR > (SELECT MAX(event_time) - INTERVAL 2 MINUTE FROM ev)""",
    "window_state_rows": """
        SELECT window_start, window_end, product_id, view_count, cart_count, purchase_count FROM agg
        WHERE window_end > (SELECT MAX(event_time) - INTERVAL 2 MINUTE FROM ev)""",
    "observed_metrics": """
        SELECT CASE WHEN bad AND uid % 3 = 0 THEN 1 WHEN uid % 2 = 0 THEN 0 ELSE 2 END AS pass, COUNT(*) AS rows,
               COUNT(*) FILTER (WHERE NOT bad) AS valid, COUNT(*) FILTER (WHERE uid % 10 = 0) AS without_time,
               COUNT(*) FILTER (WHERE NOT bad AND event_type = 'view') AS "view",
               COUNT(*) FILTER (WHERE NOT bad AND event_type = 'add_to_cart') AS add_to_cart,
               COUNT(*) FILTER (WHERE NOT bad AND event_type = 'purchase') AS purchase
        FROM (SELECT *, uid % 10 = 0 OR event_type = 'error' AS bad FROM ev) GROUP BY 1""",
    "failing_query_stops_all": """
        SELECT * FROM (VALUES ('raw_events', 'stopped', NULL), ('quarantine', 'stopped', NULL),
                              ('window_aggregates', 'failed', 'FOREACH_BATCH_USER_FUNCTION_ERROR'))
                 AS t(query_name, outcome, error_class)""",
    "raw_first_writer": """
        SELECT event_id, arg_min('COPY' || copy || substr(user_id, 5), place) AS user_id, any_value(product_id) AS product_id,
               any_value(category) AS category, any_value(event_type) AS event_type, any_value(event_time) AS event_time
        FROM (SELECT *, CASE copy WHEN 2 THEN uid % 2 + 1 ELSE uid % 2 END * 100000000000
                        + CASE copy WHEN 2 THEN -uid - 1 WHEN 1 THEN 3 * uid + uid % 2 * 2 - 1 ELSE 3 * uid END AS place
              FROM (SELECT *, unnest([0, 1, 2]) AS copy FROM valid))
        GROUP BY event_id""",
    "rerun_after_crash": "decode_valid",
    "replay_twice": """
        SELECT 'raw' AS name, COUNT(*) AS rows, CAST(COUNT(DISTINCT event_id) AS BIGINT) AS total FROM valid
        UNION ALL
        SELECT 'aggregates', COUNT(*), CAST(SUM(view_count + cart_count + purchase_count) AS BIGINT) FROM agg""",
    "raw_cross_date_ids": "decode_valid",
    "raw_insert_ignore": "decode_valid",
    "sliding_counts_stream": "sliding_counts",
    "flash_sale_latched": _LATCHED,
    "replay_equals_batch": "daily_top_products",
    "aggregates_upsert": "sliding_counts",
    "user_segments_replace": "user_segments",
    "daily_report_replace": "daily_top_products",
    "report_readback": "panel_daily_top",
    "late_rows_dropped": _LATE,
    "progress_metrics": _PROGRESS,
}
