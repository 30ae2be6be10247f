"""Zone map of the alert log: only slices that decide a range are read."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.sinks import keyed, zones

KEYS = ["product_id", "window_start"]
AT = "window_start timestamp, product_id string, view_count long, created_at timestamp"


def put(spark, table, batch, rows, zoned=True):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(w), p, v, dt.datetime.fromisoformat(c)) for w, p, v, c in rows], AT)
    df = df.withColumn(keyed.WINDOW_DATE, F.to_date("window_start"))
    zones.forget(spark, table, batch)
    keyed.upsert(df, table, batch, partition_by=(keyed.WINDOW_DATE,))
    if zoned:
        zones.record(spark, table, batch, keyed.WINDOW_DATE, "created_at")


def seen(spark, table, start, end):
    found = zones.current_in_range(spark, table, KEYS, "created_at", start, end)
    rows = found.where(F.col("created_at").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    slices = sorted({"/".join(f.split("/")[-3:-1]) for f in found.inputFiles()})
    return sorted((r.product_id, r.view_count) for r in rows.collect()), slices


def test_only_deciding_slices_are_read(spark, scratch):
    put(spark, scratch, 0, [("2024-01-01 10:00", "a", 1, "2024-01-01 11:00"), ("2024-01-02 10:00", "b", 1, "2024-01-02 11:00")])
    put(spark, scratch, 1, [("2024-01-02 10:00", "b", 2, "2024-01-03 11:00")])  # an older window, alerted again later
    put(spark, scratch, 2, [("2024-01-03 10:00", "c", 1, "2024-01-03 12:00")])
    assert seen(spark, scratch, "2024-01-01 00:00:00", "2024-01-01 23:00:00") == ([("a", 1)], ["window_date=2024-01-01/batch_id=0"])
    # the range holds b's first version only, which is not the current one: the later slice of its date is read too
    assert seen(spark, scratch, "2024-01-02 00:00:00", "2024-01-02 23:00:00") == (
        [], ["window_date=2024-01-02/batch_id=0", "window_date=2024-01-02/batch_id=1"])
    assert seen(spark, scratch, "2024-01-03 00:00:00", "2024-01-03 23:00:00") == (
        [("b", 2), ("c", 1)], ["window_date=2024-01-02/batch_id=1", "window_date=2024-01-03/batch_id=2"])
    assert seen(spark, scratch, "2024-02-01 00:00:00", "2024-02-02 00:00:00") == ([], [])


def test_slices_without_a_zone_and_compacted_ones_are_read(spark, scratch):
    put(spark, scratch, 0, [("2024-01-01 10:00", "a", 1, "2024-01-01 11:00")])
    put(spark, scratch, 1, [("2024-01-01 10:00", "a", 2, "2024-01-01 12:00")])
    put(spark, scratch, 2, [("2024-01-05 10:00", "d", 1, "2024-01-01 12:30")], zoned=False)  # crashed before its zone
    assert seen(spark, scratch, "2024-01-01 00:00:00", "2024-01-01 23:00:00")[0] == [("a", 2), ("d", 1)]
    keyed.compact_dates(spark, scratch, keyed.WINDOW_DATE, ["2024-01-01"], keys=KEYS)
    found, slices = seen(spark, scratch, "2024-01-01 00:00:00", "2024-01-01 23:00:00")
    assert found == [("a", 2), ("d", 1)] and "window_date=2024-01-01/batch_id=-1" in slices
