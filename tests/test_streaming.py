"""Streaming job on five one-file micro-batches (FIXTURES §5), watermark 2 min, 10 min / 1 min windows."""

import json

import pytest
from pyspark.sql import functions as F

from cartwheel.config import StreamSettings
from cartwheel.sinks import keyed
from cartwheel.streaming import job, replay
from cartwheel.streaming.progress import progress_rows

from helpers import WIRE_SCHEMA, event, wire

DAY = "2024-01-15T00:"
BATCHES = [
    [event("dup", "PROD-001", "view", DAY + "05:00+00:00"),
     event("dup", "PROD-001", "view", DAY + "05:00+00:00"),  # same id inside the batch
     event("v3", "PROD-001", "view", DAY + "05:00+00:00")],
    [event("p1", "PROD-001", "purchase", DAY + "05:30+00:00"),
     event("dup", "PROD-001", "purchase", DAY + "05:30+00:00")],  # same id in the next batch
    [event("q1", "PROD-002", "view", DAY + "30:00+00:00")],
    [event("l1", "PROD-001", "view", DAY + "17:59+00:00"),
     event("l2", "PROD-001", "view", DAY + "27:00+00:00")],
    [event("l3", "PROD-003", "view", DAY + "18:30+00:00")],
]


@pytest.fixture(scope="module")
def run(spark):
    from cartwheel.session import scratch_path

    root = scratch_path(spark, "stream-test")
    for i, batch in enumerate(BATCHES):
        wire(spark, batch).coalesce(1).write.parquet(f"{root}/source/part={i:05d}")
    stream = replay.read_slices(spark, f"{root}/source", WIRE_SCHEMA)
    settings = StreamSettings(min_views=2, max_purchases=1)
    started = job.start(spark, stream, f"{root}/out", settings, trigger={"availableNow": True})
    job.await_all(started)
    progress = [json.loads(p.json) if hasattr(p, "json") else dict(p)
                for p in started["aggregates"].recentProgress]
    return started["paths"], progress


def _slice_count(spark, path, batch_id):
    written = keyed.read_batch(spark, path, batch_id, keyed.WINDOW_DATE)
    return 0 if written is None else written.count()


def test_rows_emitted_per_batch(spark, run):
    paths, _ = run
    assert [_slice_count(spark, paths.aggregates, b) for b in range(5)] == [10, 10, 10, 20, 0]


def test_latched_alerts(spark, run):
    paths, _ = run
    assert _slice_count(spark, paths.alerts, 0) == 10
    assert _slice_count(spark, paths.alerts, 1) == 0
    alerts = keyed.current(spark, paths.alerts, ["product_id", "window_start", "window_end"])
    assert alerts.count() == 10  # kept although the windows no longer qualify
    aggs = keyed.current(spark, paths.aggregates, ["window_start", "window_end", "product_id"])
    p1 = aggs.where((F.col("product_id") == "PROD-001")
                    & (F.col("window_start") == F.lit("2024-01-15 00:05:00").cast("timestamp"))).first()
    assert (p1.view_count, p1.purchase_count) == (3, 2)  # the duplicate id is counted in windows
    qualifying_now = aggs.where((F.col("view_count") > 2) & (F.col("purchase_count") < 1)).count()
    assert qualifying_now == 0


def test_late_rows(spark, run):
    paths, progress = run
    aggs = keyed.current(spark, paths.aggregates, ["window_start", "window_end", "product_id"])
    # 00:17:59 arrived after the watermark reached 00:28 but was still counted (one-batch lag)
    late = aggs.where((F.col("product_id") == "PROD-001")
                      & (F.col("window_start") == F.lit("2024-01-15 00:17:00").cast("timestamp"))).first()
    assert late.view_count == 1
    assert aggs.where(F.col("product_id") == "PROD-003").count() == 0  # dropped
    dropped = {r[1]: r[6] for r in progress_rows(progress)}
    assert dropped[4] > 0


def test_raw_table_keeps_first(spark, run):
    paths, _ = run
    raw = keyed.union_of_slices(spark, paths.raw)
    assert [c for c in raw.columns if c.startswith("_")] == []  # ordering helpers are not stored
    rows = {r.event_id: r for r in raw.collect()}
    assert rows["dup"].event_type == "view"
    assert raw.count() == len(set(e["event_id"] for b in BATCHES for e in b))


def test_dedup_within_watermark_option(spark):
    from cartwheel.session import scratch_path

    root = scratch_path(spark, "stream-dedup")
    batches = [BATCHES[0], [event("dup", "PROD-001", "view", DAY + "05:10+00:00")]]
    for i, batch in enumerate(batches):
        wire(spark, batch).coalesce(1).write.parquet(f"{root}/source/part={i:05d}")
    stream = replay.read_slices(spark, f"{root}/source", WIRE_SCHEMA)
    started = job.start(spark, stream, f"{root}/out", StreamSettings(min_views=2, max_purchases=1),
                        trigger={"availableNow": True}, dedup_within_watermark=True)
    job.await_all(started)
    aggs = keyed.current(spark, started["paths"].aggregates, ["window_start", "window_end", "product_id"])
    row = aggs.where(F.col("window_start") == F.lit("2024-01-15 00:05:00").cast("timestamp")).first()
    assert row.view_count == 2  # "dup" counted once although delivered three times


def test_failure_of_any_query_surfaces_and_stops_the_others(spark):
    import time

    from cartwheel.session import scratch_path

    root = scratch_path(spark, "stream-fail")
    forever = (spark.readStream.format("rate").option("rowsPerSecond", 1).load()
               .writeStream.format("noop").trigger(processingTime="1 second")
               .option("checkpointLocation", f"{root}/ck-forever").start())

    def sink_down(df, batch_id):
        raise ValueError("sink down")

    wire(spark, [event("x")]).write.parquet(f"{root}/source/part=00000")
    failing = (replay.read_slices(spark, f"{root}/source", WIRE_SCHEMA).writeStream
               .foreachBatch(sink_down).option("checkpointLocation", f"{root}/ck-failing")
               .trigger(availableNow=True).start())
    t0 = time.monotonic()
    with pytest.raises(Exception, match="sink down"):
        job.await_all({"first": forever, "second": failing, "streams": spark.streams}, timeout=120)
    assert time.monotonic() - t0 < 100
    assert not forever.isActive and not failing.isActive


def test_tables_of_a_time_range(spark, run):
    paths, _ = run
    whole = job.tables(spark, paths)
    day = job.tables(spark, paths, "2024-01-15 00:00:00", "2024-01-15 02:00:00")
    for name in ("clickstream_events", "product_view_aggregates"):
        assert sorted(whole[name].collect()) == sorted(day[name].collect()), name
    later = job.tables(spark, paths, "2024-01-20 00:00:00", "2024-01-20 02:00:00")
    assert later["product_view_aggregates"].count() == 0
    # alerts are asked for by the time they were written, whatever their window
    assert later["flash_sale_alerts"].count() == 0 < whole["flash_sale_alerts"].count()
    written = job.tables(spark, paths, "2024-01-20 00:00:00", "2999-01-01 00:00:00")["flash_sale_alerts"]
    assert sorted(written.collect()) == sorted(whole["flash_sale_alerts"].collect())


def test_windows_longer_than_a_day_stay_in_a_range(spark, scratch):
    import datetime as dt

    paths = job.JobPaths(scratch)
    row = [(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 13), "P1", 1, 0, 0)]
    aggs = spark.createDataFrame(row, "window_start timestamp, window_end timestamp, product_id string, "
                                      "view_count long, cart_count long, purchase_count long")
    keyed.upsert(job.with_window_date(aggs), paths.aggregates, 0, partition_by=(keyed.WINDOW_DATE,))
    keyed.upsert(job.with_window_date(aggs.withColumn("created_at", F.current_timestamp())), paths.alerts, 0,
                 partition_by=(keyed.WINDOW_DATE,))
    aggs.withColumn("event_time", F.col("window_start")).withColumn("event_date", F.to_date("event_time")) \
        .write.partitionBy("event_date").parquet(paths.raw)
    found = job.tables(spark, paths, "2024-01-13", "2024-01-14", StreamSettings(window="3 days"))
    assert found["product_view_aggregates"].count() == 1


def test_wide_raw_option(spark):
    from cartwheel.session import scratch_path

    root = scratch_path(spark, "stream-wide")
    wire(spark, BATCHES[0]).coalesce(1).write.parquet(f"{root}/source/part=00000")
    stream = replay.read_slices(spark, f"{root}/source", WIRE_SCHEMA)
    started = job.start(spark, stream, f"{root}/out", StreamSettings(), trigger={"availableNow": True},
                        wide_raw=True)
    job.await_all(started)
    raw = keyed.union_of_slices(spark, started["paths"].raw)
    assert {"session_id", "device", "referrer", "kafka_timestamp"} <= set(raw.columns)
    assert sorted(r.event_id for r in raw.collect()) == ["dup", "v3"]


def test_progress_listener_and_graceful_stop(spark, capsys):
    import time

    from cartwheel.session import scratch_path
    from cartwheel.streaming.progress import ProgressLog

    root = scratch_path(spark, "stream-stop")
    log = ProgressLog(keep=3)
    spark.streams.addListener(log)
    try:
        q = (spark.readStream.format("rate").option("rowsPerSecond", 5).load()
             .writeStream.format("noop").trigger(processingTime="1 second").queryName("rate_probe")
             .option("checkpointLocation", f"{root}/ck").start())
        t0 = time.monotonic()
        while len([p for p in log.recent if p.get("name") == "rate_probe"]) < 3 and time.monotonic() - t0 < 60:
            time.sleep(0.5)
        job.stop_gracefully({"q": q}, timeout=30)
        assert not q.isActive
    finally:
        spark.streams.removeListener(log)
    assert len(log.recent) == 3  # bounded
    assert "[progress] rate_probe batch=" in capsys.readouterr().out


def test_state_partitions_are_bounded_whatever_the_session_has(spark, scratch):
    """The state has at most the asked partitions, in RocksDB, and the session's own settings stay."""
    from cartwheel.streaming import state

    store = "spark.sql.streaming.stateStore.providerClass"
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", store)}
    wire(spark, BATCHES[0]).coalesce(1).write.parquet(f"{scratch}/source/part=00000")
    stream = replay.read_slices(spark, f"{scratch}/source", WIRE_SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.unset(store)
    try:
        started = job.start(spark, stream, f"{scratch}/out", trigger={"availableNow": True}, state_partitions=5,
                            window_partitions=3)
        job.await_all(started)
        assert (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(store, "")) == ("9", "")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    found = {n: state.state_operators(spark, started["paths"].checkpoint(n)).first().numPartitions
             for n in ("raw_events", "aggregates")}
    assert found == {"raw_events": 5, "aggregates": 3}
    offsets = spark.read.text(f"{started['paths'].checkpoint('raw_events')}/offsets/0", wholetext=True).first()[0]
    assert job.ROCKSDB in offsets
    # an id's state keeps the columns that the table stores
    value = state.state_rows(spark, started["paths"].checkpoint("raw_events")).schema["value"].dataType.simpleString()
    assert "user_id" in value and "session_id" not in value and "referrer" not in value
    assert keyed.union_of_slices(spark, started["paths"].raw).count() == 2
