"""Composed jobs with their reads and writes.

    python -m cartwheel.plans.jobs daily-report   --raw <raw table> --table <report table> --text <dir> --date 2024-01-15
    python -m cartwheel.plans.jobs segments       --raw <raw table> --table <segments table> --date 2024-01-15
    python -m cartwheel.plans.jobs conversion     --raw <raw table> --out <dir> [--date 2024-01-15]
    python -m cartwheel.plans.jobs flash-audit    --aggregates <aggregates log> [--date 2024-01-15 [--end ...]]
    python -m cartwheel.plans.jobs compact        --table <raw table or window log> --date 2024-01-14 [--end ...] [--log raw|aggregates|alerts]

``--date`` is the scheduled interval's start, with or without a time of day; ``--end`` its end (a day
later by default). A run makes one report for the interval, dated by its start;
``--backfill`` makes one for every calendar day of it in one job.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import StreamSettings
from cartwheel.operators import alerts, daily
from cartwheel.schemas import KEYS
from cartwheel.session import checkpoint_root
from cartwheel.sinks import keyed, partitions, reports
from cartwheel.sources.tables import as_timestamp, dates_between, read_events_range


def interval(date=None, end=None):
    """``[date, end)``; one UTC day by default; today (UTC) when no date is given."""
    start = as_timestamp(date) if date else dt.datetime.combine(dt.datetime.now(dt.timezone.utc).date(), dt.time())
    stop = as_timestamp(end) if end else start + dt.timedelta(days=1)
    return start, stop


def dated(start, end, backfill: bool):
    """The date that stands for the interval (None: every event's own), and the dates a run replaces."""
    first = as_timestamp(start).date()
    return (None, start, end) if backfill else (first, first, first + dt.timedelta(days=1))


def with_defaults(df: DataFrame, counts=(), stamps=()) -> DataFrame:
    """Column defaults of the stored tables: 0 for counts, the clock for time stamps."""
    for c in counts:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast("long")))
    for c in stamps:
        df = df.withColumn(c, F.coalesce(F.col(c), F.current_timestamp())) if c in df.columns \
            else df.withColumn(c, F.current_timestamp())
    return df


def daily_product_report(spark: SparkSession, events: DataFrame, table: str, text_dir: str | None,
                         start, end, backfill: bool = False) -> DataFrame:
    """Top products of the interval (or per day) -> replace the dates in the table -> read back -> text report."""
    as_date, first, last = dated(start, end, backfill)
    report = with_defaults(daily.daily_top_products(events, start, end, as_date=as_date), stamps=("created_at",))
    partitions.replace_dates(spark, report, table, "report_date", first, last)
    stored = partitions.read_dates(spark, table, "report_date", first, last)
    if text_dir:
        days = reports.report_days(spark, first, last)
        reports.write_text(reports.top_products_lines(stored, days), text_dir)
    return stored.orderBy("report_date", "rank")


def user_segmentation(spark: SparkSession, events: DataFrame, table: str, start, end,
                      three_way: bool = False, backfill: bool = False) -> DataFrame:
    """Segments of the interval (or per day) -> replace the dates in the table."""
    as_date, first, last = dated(start, end, backfill)
    segs = with_defaults(daily.user_segments(events, start, end, three_way=three_way, as_date=as_date),
                         counts=("total_views", "total_purchases"), stamps=("created_at",))
    partitions.replace_dates(spark, segs, table, "segment_date", first, last)
    return partitions.read_dates(spark, table, "segment_date", first, last)


def conversion_report(spark: SparkSession, events: DataFrame, out_dir: str, start, end,
                      backfill: bool = False) -> None:
    """Per-product conversion CSV and the category summary text, one file each per interval (or day).

    The per-product rows (one per date, category and product) feed both outputs; they are
    checkpointed once to the shared folder, so the events are scanned once.
    """
    checkpoint_root(spark)
    as_date, first, last = dated(start, end, backfill)
    conv = daily.conversion_by_product(events, start, end, as_date).checkpoint()
    reports.write_csv(reports.conversion_csv_rows(conv), f"{out_dir}/conversion_rates")
    days = reports.report_days(spark, first, last)
    reports.write_text(reports.category_summary_lines(daily.category_conversion(conv), days),
                       f"{out_dir}/category_conversion_summary")


def flash_sale_audit(spark: SparkSession, aggregates: DataFrame,
                     settings: StreamSettings = StreamSettings(), show: bool = True) -> DataFrame:
    """The rule on the current aggregates (not latched); prints candidates or a note."""
    found = alerts.flash_sale(aggregates, settings.min_views, settings.max_purchases, settings.alert_message)
    if show:
        reports.show_candidates(found)
    return found


def compact_closed_dates(spark: SparkSession, table: str, log: str, start, end) -> list:
    """Maintenance: one slice per closed date of a stream-written log (raw events by event
    date, window logs by window date, latest row per key)."""
    dates = dates_between(start, end - dt.timedelta(microseconds=1))
    if log == "raw":
        return keyed.compact_dates(spark, table, "event_date", dates)
    keys = KEYS["product_view_aggregates" if log == "aggregates" else "flash_sale_alerts"]
    return keyed.compact_dates(spark, table, keyed.WINDOW_DATE, dates, keys=keys)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cartwheel-jobs")
    ap.add_argument("job", choices=["daily-report", "segments", "conversion", "flash-audit", "compact"])
    ap.add_argument("--log", choices=["raw", "aggregates", "alerts"], default="raw")
    ap.add_argument("--raw")
    ap.add_argument("--table")
    ap.add_argument("--text")
    ap.add_argument("--out")
    ap.add_argument("--aggregates")
    ap.add_argument("--date")
    ap.add_argument("--end")
    ap.add_argument("--three-way", action="store_true")
    ap.add_argument("--backfill", action="store_true", help="one report for each calendar day of the interval")
    args = ap.parse_args(argv)

    from cartwheel.session import build_session

    spark = build_session(app_name=f"cartwheel-{args.job}")
    start, end = interval(args.date, args.end)
    if args.job == "flash-audit":
        # whole table by default; with --date only the window-date folders of the interval
        dates = dates_between(start, end - dt.timedelta(microseconds=1)) if args.date else None
        flash_sale_audit(spark, keyed.current(spark, args.aggregates, KEYS["product_view_aggregates"],
                                              dates=dates))
        return
    if args.job == "compact":
        compact_closed_dates(spark, args.table, args.log, start, end)
        return
    events = read_events_range(spark, args.raw, start, end)
    if args.job == "daily-report":
        daily_product_report(spark, events, args.table, args.text, start, end, args.backfill).show(truncate=False)
    elif args.job == "segments":
        user_segmentation(spark, events, args.table, start, end, args.three_way, args.backfill)
    else:
        conversion_report(spark, events, args.out, start, end, args.backfill)


if __name__ == "__main__":
    main()
