"""Keyed sinks: insert-ignore, upsert replay, date-partition replacement (K1-K5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.sinks import keyed, partitions

from helpers import ts, typed


def _raw(spark, rows):
    return typed(spark, rows).withColumn("event_date", F.to_date("event_time"))


def test_insert_ignore_first_wins(spark, scratch):
    b0 = _raw(spark, [
        ("e1", "u1", "P1", None, "view", ts("2024-01-15 10:00:00")),
        ("e1", "u2", "P1", None, "view", ts("2024-01-15 10:00:05")),  # same id later in the batch
        ("e2", "u1", "P2", None, "view", ts("2024-01-15 10:01:00")),
    ])
    keyed.insert_ignore(spark, b0, scratch, 0)
    b1 = _raw(spark, [
        ("e2", "u9", "P9", None, "purchase", ts("2024-01-15 11:00:00")),  # seen before
        ("e3", "u1", "P3", None, "view", ts("2024-01-15 11:00:00")),
    ])
    keyed.insert_ignore(spark, b1, scratch, 1)
    keyed.insert_ignore(spark, b1, scratch, 1)  # replay of batch 1
    got = sorted((r.event_id, r.user_id) for r in keyed.union_of_slices(spark, scratch).collect())
    assert got == [("e1", "u1"), ("e2", "u1"), ("e3", "u1")]


def test_insert_ignore_shuffle_path(spark, scratch):
    b0 = _raw(spark, [("e1", "u1", "P1", None, "view", ts("2024-01-15 10:00:00"))])
    keyed.insert_ignore(spark, b0, scratch, 0, broadcast_limit=0)
    keyed.insert_ignore(spark, b0, scratch, 1, broadcast_limit=0)
    assert keyed.union_of_slices(spark, scratch).count() == 1


def test_insert_ignore_probes_only_batch_dates(spark, scratch):
    b0 = _raw(spark, [
        ("e1", "u1", "P1", None, "view", ts("2024-01-15 10:00:00")),
        ("e2", "u1", "P2", None, "view", ts("2024-01-16 10:00:00")),
    ])
    keyed.insert_ignore(spark, b0, scratch, 0, probe_by="event_date")
    assert {p.name for p in __import__("pathlib").Path(scratch).iterdir() if p.is_dir()} == {
        "event_date=2024-01-15", "event_date=2024-01-16"}
    b1 = _raw(spark, [
        ("e1", "u2", "P1", None, "view", ts("2024-01-15 10:00:00")),  # redelivery: same time
        ("e3", "u1", "P3", None, "view", ts("2024-01-17 09:00:00")),
    ])
    keyed.insert_ignore(spark, b1, scratch, 1, probe_by="event_date")
    keyed.insert_ignore(spark, b1, scratch, 1, probe_by="event_date")  # replay of batch 1
    got = sorted((r.event_id, r.user_id, r.batch_id) for r in
                 spark.read.parquet(scratch).collect())
    assert got == [("e1", "u1", 0), ("e2", "u1", 0), ("e3", "u1", 1)]
    # an id coming back under another date is only caught by the whole-history probe
    b2 = _raw(spark, [("e2", "u7", "P2", None, "view", ts("2024-01-18 10:00:00"))])
    keyed.insert_ignore(spark, b2, scratch, 2)
    assert keyed.union_of_slices(spark, scratch).where("event_id = 'e2'").count() == 1
    keyed.insert_ignore(spark, b2, scratch, 3, probe_by="event_date")
    assert keyed.union_of_slices(spark, scratch).where("event_id = 'e2'").count() == 2


def test_read_partitions_lists_only_asked_folders(spark, scratch):
    from cartwheel.sources.tables import read_events_range, read_partitions

    rows = _raw(spark, [
        ("e1", "u1", "P1", None, "view", ts("2024-01-15 10:00:00")),
        ("e2", "u1", "P2", None, "view", ts("2024-01-16 10:00:00")),
        ("e3", "u1", "P2", None, "view", ts("2024-01-17 10:00:00")),
    ])
    rows.write.partitionBy("event_date").parquet(scratch)
    assert read_partitions(spark, scratch, "event_date", ["2024-02-01"]) is None
    part = read_partitions(spark, scratch, "event_date", [dt.date(2024, 1, 16), dt.date(2024, 1, 19)])
    assert [r.event_id for r in part.collect()] == ["e2"]
    assert "event_date=2024-01-15" not in " ".join(part.inputFiles())
    got = sorted(r.event_id for r in read_events_range(spark, scratch, "2024-01-16", "2024-01-18").collect())
    assert got == ["e2", "e3"]
    assert read_events_range(spark, scratch, "2024-03-01", "2024-03-02").count() == 0


def test_upsert_latest_wins_and_replay(spark, scratch):
    schema = "k string, v long"
    keyed.upsert(spark.createDataFrame([("a", 1), ("b", 1)], schema), scratch, 0)
    keyed.upsert(spark.createDataFrame([("a", 2)], schema), scratch, 1)
    keyed.upsert(spark.createDataFrame([("a", 2)], schema), scratch, 1)
    got = sorted(tuple(r) for r in keyed.current(spark, scratch, ["k"]).collect())
    assert got == [("a", 2), ("b", 1)]
    keyed.compact(spark, scratch, ["k"], scratch + "-compact", upto_batch=1)
    assert sorted(tuple(r) for r in keyed.current(spark, scratch + "-compact", ["k"]).collect()) == got


def test_replace_dates_clears_empty_day(spark, scratch):
    schema = "segment_date date, user_id string"
    d15, d16 = dt.date(2024, 1, 15), dt.date(2024, 1, 16)
    first = spark.createDataFrame([(d15, "u1"), (d16, "u2")], schema)
    partitions.replace_dates(spark, first, scratch, "segment_date", "2024-01-15", "2024-01-17")
    again = spark.createDataFrame([(d15, "u3")], schema)
    cleared = partitions.replace_dates(spark, again, scratch, "segment_date", "2024-01-15", "2024-01-17")
    assert cleared == [d16]
    got = sorted((str(r.segment_date), r.user_id) for r in spark.read.parquet(scratch).collect())
    assert got == [("2024-01-15", "u3")]


def test_replace_dates_with_empty_result_clears_the_range(spark, scratch):
    schema = "segment_date date, user_id string"
    d15, d16 = dt.date(2024, 1, 15), dt.date(2024, 1, 16)
    partitions.replace_dates(spark, spark.createDataFrame([(d15, "u1"), (d16, "u2")], schema),
                             scratch, "segment_date", "2024-01-15", "2024-01-17")
    empty = spark.createDataFrame([(d15, "u1")], schema).where("user_id = 'none'")
    cleared = partitions.replace_dates(spark, empty, scratch, "segment_date", "2024-01-16", "2024-01-17")
    assert cleared == [d16]
    got = sorted((str(r.segment_date), r.user_id) for r in spark.read.parquet(scratch).collect())
    assert got == [("2024-01-15", "u1")]


def test_window_log_laid_out_by_date(spark, scratch):
    schema = "window_start timestamp, product_id string, v long"
    by_date = (keyed.WINDOW_DATE,)

    def frame(rows):
        return spark.createDataFrame(rows, schema).withColumn(keyed.WINDOW_DATE, F.to_date("window_start"))

    d15, d16 = dt.date(2024, 1, 15), dt.date(2024, 1, 16)
    b0 = frame([(ts("2024-01-15 23:00:00"), "P1", 1), (ts("2024-01-16 01:00:00"), "P1", 1)])
    assert keyed.upsert(b0, scratch, 0, partition_by=by_date, observe=True) == {d15, d16}
    b1 = frame([(ts("2024-01-16 01:00:00"), "P1", 5)])
    assert keyed.upsert(b1, scratch, 1, partition_by=by_date, observe=True) == {d16}
    keys = ["window_start", "product_id"]
    full = sorted(tuple(r) for r in keyed.current(spark, scratch, keys).collect())
    assert full == [(ts("2024-01-15 23:00:00"), "P1", 1), (ts("2024-01-16 01:00:00"), "P1", 5)]
    one_day = keyed.current(spark, scratch, keys, dates=[d16])
    assert [r.v for r in one_day.collect()] == [5]
    assert "window_date=2024-01-15" not in " ".join(one_day.inputFiles())
    assert keyed.current(spark, scratch, keys, dates=[dt.date(2024, 2, 1)]).count() == 0
    assert keyed.read_batch(spark, scratch, 1, keyed.WINDOW_DATE, {d16}).count() == 1
    assert keyed.read_batch(spark, scratch, 0, keyed.WINDOW_DATE).count() == 2
    assert keyed.read_batch(spark, scratch, 2, keyed.WINDOW_DATE) is None
    keyed.compact(spark, scratch, keys, scratch + "-c", upto_batch=1)
    assert sorted(tuple(r) for r in keyed.current(spark, scratch + "-c", keys).collect()) == full
    assert keyed.read_batch(spark, scratch + "-c", 1, keyed.WINDOW_DATE, {d15, d16}).count() == 2


def test_history_probe_limited_to_batch_dates_and_time_span(spark, scratch):
    b0 = _raw(spark, [
        ("e1", "u1", "P1", None, "view", ts("2024-01-15 10:00:00")),
        ("e2", "u1", "P2", None, "view", ts("2024-01-15 18:00:00")),
        ("e3", "u1", "P3", None, "view", ts("2024-01-16 10:00:00")),
    ])
    keyed.insert_ignore(spark, b0, scratch, 0, probe_by="event_date", probe_range="event_time")
    b1 = _raw(spark, [
        ("e1", "u2", "P1", None, "view", ts("2024-01-15 10:00:00")),  # redelivery
        ("e4", "u1", "P4", None, "view", ts("2024-01-15 10:30:00")),
    ])
    probe, n_keys = keyed.history_keys(spark, scratch, b1, 1, "event_id", "event_date", "event_time")
    assert n_keys == 2 and [r.event_id for r in probe.collect()] == ["e1"]  # e2 lies outside the span
    text = probe._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(event_time" in text and "LessThanOrEqual(event_time" in text
    assert "event_date=2024-01-16" not in " ".join(probe.inputFiles())
    keyed.insert_ignore(spark, b1, scratch, 1, probe_by="event_date", probe_range="event_time")
    got = sorted((r.event_id, r.user_id) for r in keyed.union_of_slices(spark, scratch).collect())
    assert got == [("e1", "u1"), ("e2", "u1"), ("e3", "u1"), ("e4", "u1")]


def test_compact_dates_keeps_rows_and_dedup(spark, scratch):
    import pathlib

    rows = [("e1", "u1", "P1", None, "view", ts("2024-01-15 10:00:00")),
            ("e2", "u1", "P2", None, "view", ts("2024-01-15 11:00:00")),
            ("e3", "u1", "P3", None, "view", ts("2024-01-16 10:00:00"))]
    for b, row in enumerate(rows):
        keyed.insert_ignore(spark, _raw(spark, [row]), scratch, b, probe_by="event_date")
    before = sorted(tuple(r) for r in keyed.union_of_slices(spark, scratch).collect())
    assert keyed.compact_dates(spark, scratch, "event_date", [dt.date(2024, 1, 15), dt.date(2024, 2, 1)]) \
        == ["2024-01-15"]
    folders = sorted(p.name for p in pathlib.Path(scratch, "event_date=2024-01-15").iterdir() if p.is_dir())
    assert folders == ["batch_id=-1"]
    assert sorted(tuple(r) for r in keyed.union_of_slices(spark, scratch).collect()) == before
    # a later batch still finds the compacted ids
    keyed.insert_ignore(spark, _raw(spark, [rows[0]]), scratch, 3, probe_by="event_date")
    assert keyed.union_of_slices(spark, scratch).count() == 3


def test_compact_dates_of_an_upsert_log_keeps_latest(spark, scratch):
    from cartwheel.plans import jobs

    schema = "window_start timestamp, window_end timestamp, product_id string, v long"

    def frame(rows):
        return spark.createDataFrame(rows, schema).withColumn(keyed.WINDOW_DATE, F.to_date("window_start"))

    by_date = (keyed.WINDOW_DATE,)
    w1 = (ts("2024-01-15 23:00:00"), ts("2024-01-15 23:10:00"))
    w2 = (ts("2024-01-16 01:00:00"), ts("2024-01-16 01:10:00"))
    keyed.upsert(frame([(*w1, "P1", 1)]), scratch, 0, partition_by=by_date)
    keyed.upsert(frame([(*w1, "P1", 4), (*w2, "P2", 2)]), scratch, 1, partition_by=by_date)
    keys = ["window_start", "window_end", "product_id"]
    before = sorted(tuple(r) for r in keyed.current(spark, scratch, keys).collect())
    jobs.main(["compact", "--table", scratch, "--log", "aggregates", "--date", "2024-01-15", "--end", "2024-01-17"])
    assert sorted(tuple(r) for r in keyed.current(spark, scratch, keys).collect()) == before
    # the newest batch stays for a re-run; of what is older one version per key is left
    assert keyed.read_log(spark, scratch).count() == 3
    keyed.upsert(frame([(*w1, "P1", 5)]), scratch, 2, partition_by=by_date)
    jobs.main(["compact", "--table", scratch, "--log", "aggregates", "--date", "2024-01-15", "--end", "2024-01-17"])
    assert keyed.read_log(spark, scratch).where("batch_id < 2").count() == 2
    got = {r.product_id: r.v for r in keyed.current(spark, scratch, keys).collect()}
    assert got == {"P1": 5, "P2": 2}


def test_insert_ignore_byte_bound_picks_the_shuffle_path(spark, scratch):
    b0 = _raw(spark, [("e1", "u1", "P1", None, "view", ts("2024-01-15 10:00:00")),
                      ("e2", "u1", "P2", None, "view", ts("2024-01-15 10:00:01"))])
    _, n_keys, key_bytes = keyed.history_keys(spark, scratch, b0, 0, "event_id", "event_date", with_bytes=True)
    assert (n_keys, key_bytes) == (2, 4)
    keyed.insert_ignore(spark, b0, scratch, 0, probe_by="event_date", broadcast_bytes=1)
    keyed.insert_ignore(spark, b0, scratch, 1, probe_by="event_date", broadcast_bytes=1)
    assert keyed.union_of_slices(spark, scratch).count() == 2


def test_rerun_of_the_last_batch_after_compaction_loses_nothing(spark, scratch):
    day = dt.date(2024, 1, 15)
    rows = [(f"e{i}", "u1", "P1", None, "view", ts("2024-01-15 10:00:00")) for i in range(3)]
    for b, row in enumerate(rows):
        keyed.write_log_rows(_raw(spark, [row]), scratch, b, ("event_date",))
    assert keyed.compact_dates(spark, scratch, "event_date", [day]) == ["2024-01-15"]
    keyed.write_log_rows(_raw(spark, [rows[2]]), scratch, 2, ("event_date",))  # the crashed batch again
    assert sorted(r.event_id for r in keyed.union_of_slices(spark, scratch).collect()) == ["e0", "e1", "e2"]
    keyed.write_log_rows(_raw(spark, [("e9", "u1", "P1", None, "view", ts("2024-01-15 11:00:00"))]), scratch, 3, ("event_date",))
    keyed.compact_dates(spark, scratch, "event_date", [day])
    assert sorted(r.event_id for r in keyed.union_of_slices(spark, scratch).collect()) == ["e0", "e1", "e2", "e9"]


def test_table_of_empty_batches_reads_as_no_rows(spark, scratch):
    """A log whose batches had no rows has no file; it still is a table with its columns (alerts of quiet windows)."""
    from cartwheel.sinks import zones

    keys, table = ["product_id", "window_start"], f"{scratch}/alerts"
    rows = spark.createDataFrame([], "product_id string, view_count long, window_start timestamp_ntz, created_at timestamp_ntz, "
                                     "window_date date")
    with pytest.raises(FileNotFoundError):
        keyed.current(spark, table, keys)
    for batch in range(2):
        keyed.upsert(rows, table, batch, partition_by=(keyed.WINDOW_DATE,))
        zones.record(spark, table, batch, keyed.WINDOW_DATE, "created_at")
        found = keyed.current(spark, table, keys)
        assert found.count() == 0 and set(found.dtypes) == set(rows.drop("window_date").dtypes)
        assert keyed.union_of_slices(spark, table).count() == 0
        assert keyed.current(spark, table, keys, dates=["2024-01-01"]).count() == 0
        assert zones.current_in_range(spark, table, keys, "created_at", "2024-01-01", "2024-02-01").count() == 0
