"""Stored topics with offset bounds (S2, L9), JSON file sink (K10), ordered CSV parts (K6, L2)."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cartwheel.sinks import reports
from cartwheel.sources import kafka, topic_log

TOPIC = "value string, partition int, offset long"


def topic(spark, scratch):
    for batch, start in enumerate((0, 100)):
        rows = [(f"{p}-{o}", p, o) for p in (2, 0, 1) for o in range(start, start + 100)]
        topic_log.write(spark.createDataFrame(rows, TOPIC), f"{scratch}/topic", batch, rows_per_file=15, parts=4)
    return f"{scratch}/topic"


def test_first_messages_open_leading_files_only(spark, scratch):
    path = topic(spark, scratch)
    files = topic_log.bounds(spark, path)
    assert files.agg(F.sum("rows")).first()[0] == 600 and files.count() >= 40
    first = topic_log.first_messages(spark, path, TOPIC, 20)
    assert [(r.partition, r.offset) for r in first.collect()] == [(0, o) for o in range(20)]
    opened = first.inputFiles()
    assert 2 <= len(opened) <= 3 and all("_partition=0" in f for f in opened)
    everything = topic_log.first_messages(spark, path, TOPIC, 1000)
    assert [(r.partition, r.offset) for r in everything.collect()] == [(p, o) for p in range(3) for o in range(200)]


def test_first_messages_of_overlapping_deliveries(spark, scratch):
    for batch, odd in enumerate((1, 0)):
        rows = [(f"{o}", 0, o) for o in range(odd, 60, 2)]
        topic_log.write(spark.createDataFrame(rows, TOPIC), f"{scratch}/o", batch, rows_per_file=10, parts=2)
    for n in (1, 7, 25, 60):
        first = topic_log.first_messages(spark, f"{scratch}/o", TOPIC, n)
        assert [r.offset for r in first.collect()] == list(range(n))


def test_replay_by_offsets(spark, scratch):
    path = topic(spark, scratch)
    rows = topic_log.read_replay(spark, path, TOPIC, starting={0: 190, 1: 500}, ending={2: 5})
    assert sorted((r.partition, r.offset) for r in rows.collect()) == [(0, o) for o in range(190, 200)] + [(2, o) for o in range(5)]
    assert len(rows.inputFiles()) <= 3
    assert topic_log.read_replay(spark, path, TOPIC).count() == 600
    assert topic_log.read_replay(spark, path, TOPIC, starting={0: 999, 1: 999, 2: 999}).count() == 0


def test_a_second_try_replaces_its_delivery(spark, scratch):
    rows = spark.createDataFrame([("a", 0, 0), ("b", 0, 1)], TOPIC)
    for _ in range(2):
        topic_log.write(rows, f"{scratch}/t", 0)
    assert [r.value for r in topic_log.first_messages(spark, f"{scratch}/t", TOPIC, 9).collect()] == ["a", "b"]
    topic_log.write(rows.limit(0), f"{scratch}/none", 0)
    assert topic_log.first_messages(spark, f"{scratch}/none", TOPIC, 5).count() == 0


def test_json_files_skip_what_no_commit_names(spark, scratch):
    schema = "id string, at timestamp, n int"
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0, 0, 123456), None), ("b", None, 2)]
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/in/1")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{scratch}/in")
    for _ in range(2):
        kafka.write_json_files(stream, f"{scratch}/out", f"{scratch}/check", {"availableNow": True}).awaitTermination()
    spark.createDataFrame(rows, schema).write.mode("append").json(f"{scratch}/lost")
    stray = [f for f in spark.read.text(f"{scratch}/lost").inputFiles()][0]
    name = spark._jvm.org.apache.hadoop.fs.Path(stray)
    files = name.getFileSystem(spark._jsc.hadoopConfiguration())
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(files, name, files, spark._jvm.org.apache.hadoop.fs.Path(
        f"{scratch}/out/part-lost.json"), False, spark._jsc.hadoopConfiguration())
    found = sorted(tuple(r) for r in kafka.read_json_files(spark, f"{scratch}/out", schema).collect())
    assert found == sorted(rows, key=lambda r: r[0])


def test_csv_parts_keep_report_order(spark, scratch):
    rows = [(dt.date(2024, 1, d), c, f"P{p:02d}", 10 + p % 3, p % 4, p % 4 / 10)
            for d in (1, 2) for c in ("A", "B") for p in range(20)]
    schema = "report_date date, category string, product_id string, total_views long, total_purchases long, conversion_rate decimal(6,4)"
    frame = spark.createDataFrame(rows, schema.replace("decimal(6,4)", "double")).withColumn(
        "conversion_rate", F.col("conversion_rate").cast("decimal(6,4)"))
    path = f"{scratch}/csv"
    reports.write_csv_parts(frame, path, rows_per_file=7, parts=3)
    reports.write_csv_parts(frame.where("report_date = '2024-01-02'"), path, rows_per_file=7, parts=3)  # the other date stays
    found = reports.read_csv_parts(
        spark, path, "category string, product_id string, total_views long, total_purchases long, conversion_rate string").collect()
    for day in (1, 2):
        mine = sorted((r for r in found if r.report_date == dt.date(2024, 1, day)), key=lambda r: r.line_no)
        assert [r.line_no for r in mine] == list(range(1, 41))
        want = sorted((x for x in rows if x[0].day == day), key=lambda x: (x[1], -x[5], -x[3], x[2]))
        assert [(r.category, r.product_id, r.total_views, r.conversion_rate) for r in mine] == [
            (x[1], x[2], x[3], f"{x[5]:.4f}") for x in want]
        names = [r.file for r in mine]
        assert names == sorted(names) and len(set(names)) >= 6 and all(re.match(r"part-\d{5}", n) for n in names)
