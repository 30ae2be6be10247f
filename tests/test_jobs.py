"""Composed daily jobs with their writes."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from cartwheel import constants as C
from cartwheel.plans import jobs

from test_daily import _rows
from helpers import typed


@pytest.fixture(scope="module")
def raw(spark):
    return typed(spark, _rows()).withColumn("event_date", F.to_date("event_time"))


def test_daily_report_job_and_empty_day(spark, raw, scratch):
    start, end = jobs.interval("2024-01-15", "2024-01-17")
    stored = jobs.daily_product_report(spark, raw, f"{scratch}/report", f"{scratch}/txt", start, end, backfill=True)
    got = [(str(r.report_date), r.rank, r.product_id) for r in stored.collect()]
    assert got[:2] == [("2024-01-15", 1, "PROD-001"), ("2024-01-15", 2, "PROD-006")]
    assert stored.where("created_at is null").count() == 0
    # the day after has one late view; re-run it with no events: its rows go, its text says so
    start2, end2 = jobs.interval("2024-01-16")
    none = raw.where(F.lit(False))
    stored2 = jobs.daily_product_report(spark, none, f"{scratch}/report", f"{scratch}/txt2", start2, end2)
    assert stored2.count() == 0
    assert spark.read.parquet(f"{scratch}/report").where("report_date = date'2024-01-15'").count() == 4
    text = open(glob.glob(f"{scratch}/txt2/report_date=2024-01-16/part-*")[0]).read().splitlines()
    assert text[-1] == C.TOP_PRODUCTS_EMPTY


def test_segments_and_conversion_jobs(spark, raw, scratch):
    start, end = jobs.interval("2024-01-15")
    segs = jobs.user_segmentation(spark, raw, f"{scratch}/segments", start, end)
    assert segs.count() == 3
    jobs.conversion_report(spark, raw, f"{scratch}/conv", start, end)
    csv = open(glob.glob(f"{scratch}/conv/conversion_rates/report_date=2024-01-15/part-*")[0]).read()
    assert csv.splitlines()[1] == "Laptops,PROD-001,32,1,0.0313"
    summary = open(glob.glob(f"{scratch}/conv/category_conversion_summary/report_date=2024-01-15/part-*")[0]).read()
    assert "Laptops | 32 | 1 | 3.12%" in summary.splitlines()


def test_flash_audit(spark, capsys):
    aggs = spark.createDataFrame(
        [("P1", 101, 0, 0, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 10)),
         ("P2", 50, 0, 0, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 10))],
        "product_id string, view_count long, cart_count long, purchase_count long, "
        "window_start timestamp, window_end timestamp")
    found = jobs.flash_sale_audit(spark, aggs)
    assert [r.product_id for r in found.collect()] == ["P1"]
    printed = capsys.readouterr().out
    assert "|P1 " in printed and "P2" not in printed
    jobs.flash_sale_audit(spark, aggs.where("view_count < 0"))
    assert "No flash-sale candidates found." in capsys.readouterr().out


def test_cli_jobs_over_the_stream_layout(spark, raw, scratch):
    from cartwheel.sinks import keyed

    table = f"{scratch}/clickstream_events"
    keyed.insert_ignore(spark, raw, table, 0, probe_by="event_date")  # event_date=D/batch_id=0
    jobs.main(["segments", "--raw", table, "--table", f"{scratch}/segments", "--date", "2024-01-15"])
    segs = spark.read.parquet(f"{scratch}/segments")
    assert segs.where("segment_date = date'2024-01-15'").count() == 3
    jobs.main(["daily-report", "--raw", table, "--table", f"{scratch}/report", "--text", f"{scratch}/txt",
               "--date", "2024-01-15", "--end", "2024-01-17", "--backfill"])
    report = spark.read.parquet(f"{scratch}/report")
    assert [r.product_id for r in report.where("report_date = date'2024-01-15'").orderBy("rank").collect()][:2] \
        == ["PROD-001", "PROD-006"]
    jobs.main(["conversion", "--raw", table, "--out", f"{scratch}/conv", "--date", "2024-01-15"])
    csv = open(glob.glob(f"{scratch}/conv/conversion_rates/report_date=2024-01-15/part-*")[0]).read()
    assert csv.splitlines()[1] == "Laptops,PROD-001,32,1,0.0313"


def test_flash_audit_cli_for_a_date(spark, scratch, capsys):
    from cartwheel.sinks import keyed
    from cartwheel.streaming.job import with_window_date

    schema = ("product_id string, view_count long, cart_count long, purchase_count long, "
              "window_start timestamp, window_end timestamp")
    aggs = spark.createDataFrame(
        [("P1", 101, 0, 0, dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15, 0, 10)),
         ("P2", 150, 0, 0, dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 16, 0, 10))], schema)
    keyed.upsert(with_window_date(aggs), f"{scratch}/aggs", 0, partition_by=(keyed.WINDOW_DATE,))
    jobs.main(["flash-audit", "--aggregates", f"{scratch}/aggs", "--date", "2024-01-16"])
    printed = capsys.readouterr().out
    assert "|P2 " in printed and "P1" not in printed
    jobs.main(["flash-audit", "--aggregates", f"{scratch}/aggs"])
    printed = capsys.readouterr().out
    assert "|P1 " in printed and "|P2 " in printed


def test_reports_of_other_dates_stay(spark, raw, scratch):
    for date in ("2024-01-15", "2024-01-16"):
        start, end = jobs.interval(date)
        jobs.daily_product_report(spark, raw, f"{scratch}/report", f"{scratch}/txt", start, end)
        jobs.conversion_report(spark, raw, f"{scratch}/conv", start, end)
    for folder in ("txt", "conv/conversion_rates", "conv/category_conversion_summary"):
        got = {p.rsplit("report_date=", 1)[1].split("/")[0] for p in glob.glob(f"{scratch}/{folder}/report_date=*/part-*")}
        assert got == {"2024-01-15", "2024-01-16"}, folder


def test_interval_that_starts_in_the_day_is_one_report(spark, raw, scratch):
    start, end = jobs.interval("2024-01-15T06:00:00")
    stored = jobs.daily_product_report(spark, raw, f"{scratch}/report", None, start, end).collect()
    assert {str(r.report_date) for r in stored} == {"2024-01-15"}
    inside = raw.where("event_time >= timestamp'2024-01-15 06:00:00' and event_time < timestamp'2024-01-16 06:00:00'")
    assert sum(r.total_views for r in stored) <= inside.where("event_type = 'view'").count()
    segs = jobs.user_segmentation(spark, raw, f"{scratch}/segs", start, end)
    assert segs.count() == inside.select("user_id").distinct().count()
    assert [str(r[0]) for r in segs.select("segment_date").distinct().collect()] == ["2024-01-15"]


def test_partial_last_day_is_read_back(spark, raw, scratch):
    start, end = jobs.interval("2024-01-15", "2024-01-16T12:00:00")
    stored = jobs.daily_product_report(spark, raw, f"{scratch}/report", f"{scratch}/txt", start, end, backfill=True)
    table = spark.read.parquet(f"{scratch}/report")
    assert stored.count() == table.count() and {str(d) for d in table.toPandas().report_date} == {"2024-01-15", "2024-01-16"}
