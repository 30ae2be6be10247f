"""First writer wins (K1), commit records of batches, and runs over the tables of earlier ones."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.config import StreamSettings
from cartwheel.sinks import keyed
from cartwheel.sources.tables import last_committed
from cartwheel.streaming import job, replay

from helpers import WIRE_SCHEMA, event, ts, typed, wire

SCHEMA = "value binary, timestamp timestamp, partition int, offset long"


def placed(spark, rows):
    """Records of (partition, offset, event)."""
    return wire(spark, [e for *_, e in rows]).withColumn("n", F.monotonically_increasing_id()).join(
        spark.createDataFrame([(i, p, o) for i, (p, o, _) in enumerate(rows)], "at long, partition int, offset long"),
        F.expr("cast(get_json_object(cast(value as string), '$.session_id') as long) = at")).select(
            "value", "timestamp", "partition", "offset")


def run(spark, root, batches, **options):
    for i, rows in enumerate(batches):
        numbered = [(p, o, {**e, "session_id": str(k)}) for k, (p, o, e) in enumerate(rows)]
        placed(spark, numbered).write.parquet(f"{root}/source/part={i:05d}")
        stream = replay.read_slices(spark, f"{root}/source", SCHEMA, files_per_trigger=None)
        started = job.start(spark, stream, f"{root}/out", StreamSettings(), trigger={"availableNow": True}, **options)
        job.await_all(started)
    return started["paths"]


def test_first_by_batch_then_offset(spark, scratch):
    paths = run(spark, scratch, [
        [(1, 7, event("a", user="late")), (1, 3, event("a", user="first")), (0, 9, event("b", user="zero")),
         (1, 1, event("b", user="one"))],
        [(0, 0, event("a", user="earlier offset, later batch")), (0, 1, event("c", user="only"))]])
    raw = keyed.union_of_slices(spark, paths.raw)
    assert sorted((r.event_id, r.user_id) for r in raw.collect()) == [("a", "first"), ("b", "zero"), ("c", "only")]
    assert last_committed(spark, paths.raw) == 1


def test_second_run_knows_the_ids_of_the_first(spark, scratch):
    first = [[(0, 0, event("a", user="first")), (0, 1, event("b", user="first"))]]
    run(spark, f"{scratch}/1", first)
    out = f"{scratch}/1/out"
    for i, rows in enumerate([[(0, 0, event("a", user="second")), (0, 1, event("c", user="second"))],
                              [(0, 2, event("b", user="second")), (0, 3, event("c", user="third"))]]):
        numbered = [(p, o, {**e, "session_id": str(k)}) for k, (p, o, e) in enumerate(rows)]
        placed(spark, numbered).write.parquet(f"{scratch}/again/part={i:05d}")
        stream = replay.read_slices(spark, f"{scratch}/again", SCHEMA, files_per_trigger=None)
        started = job.start(spark, stream, out, StreamSettings(), trigger={"availableNow": True}, run="again")
        job.await_all(started)
        # the known ids come with the run's first batch only
        read = [s["numInputRows"] for p in started["raw"].recentProgress for s in p["sources"] if "known-ids" in s["description"]]
        assert sum(read) == (2 if i == 0 else 0)
    raw = keyed.union_of_slices(spark, started["paths"].raw)
    assert sorted((r.event_id, r.user_id) for r in raw.collect()) == [("a", "first"), ("b", "first"), ("c", "second")]


def test_second_run_over_tables_without_raw_rows(spark, scratch):
    wire(spark, ["not json", {"event_id": "x"}]).write.parquet(f"{scratch}/bad/part=00000")
    wire(spark, [event("a")]).write.parquet(f"{scratch}/good/part=00000")
    for name, options in (("bad", {}), ("good", {"run": "again"})):
        stream = replay.read_slices(spark, f"{scratch}/{name}", WIRE_SCHEMA, files_per_trigger=None)
        started = job.start(spark, stream, f"{scratch}/out", StreamSettings(), trigger={"availableNow": True}, **options)
        job.await_all(started)
    paths = started["paths"]
    assert [r.event_id for r in keyed.union_of_slices(spark, paths.raw).collect()] == ["a"]
    assert keyed.read_log(spark, paths.quarantine).count() == 2


def dated(spark, rows):
    return typed(spark, [(i, "u", "P1", None, "view", ts(t)) for i, t in rows]).withColumn("event_date", F.to_date("event_time"))


def test_a_second_try_leaves_nothing_of_the_first(spark, scratch):
    by_date = ("event_date",)
    keyed.write_log_rows(dated(spark, [("a", "2024-01-01 10:00:00")]), scratch, 0, by_date)
    keyed.write_log_rows(dated(spark, [("a", "2024-01-02 10:00:00")]), scratch, 0, by_date)
    assert [str(r.event_date) for r in keyed.union_of_slices(spark, scratch).collect()] == ["2024-01-02"]


def test_rows_of_an_uncommitted_batch_are_not_seen(spark, scratch):
    by_date = ("event_date",)
    keyed.write_log_rows(dated(spark, [("a", "2024-01-01 10:00:00")]), scratch, 0, by_date)
    keyed.begin_batch(spark, scratch, 1, 1)
    dated(spark, [("b", "2024-01-01 11:00:00"), ("c", "2024-01-05 11:00:00")]).withColumn("batch_id", F.lit(1)).write.mode(
        "append").partitionBy("event_date", "batch_id").parquet(scratch)
    assert [r.event_id for r in keyed.union_of_slices(spark, scratch).collect()] == ["a"]
    from cartwheel.sources.tables import read_events_range, read_partitions
    assert read_partitions(spark, scratch, "event_date", [dt.date(2024, 1, 1)]).count() == 1
    assert read_events_range(spark, scratch, "2024-01-01", "2024-02-01").count() == 1
    keyed.write_log_rows(dated(spark, [("b", "2024-01-01 11:00:00")]), scratch, 1, by_date)
    assert sorted((r.event_id, str(r.event_date)) for r in keyed.union_of_slices(spark, scratch).collect()) == [
        ("a", "2024-01-01"), ("b", "2024-01-01")]
    assert last_committed(spark, scratch) == 1
