"""The stored tables, derived from the driver's ``events`` table by the library operators.

These stand in for what the stream and the daily jobs write. ``stored`` writes them once for
each session and folder with the job's own sinks; panels read those tables through their date
folders, as the dashboard reads its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators import alerts, daily, decode, windows
from cartwheel.plans import params as P
from cartwheel.operators.windows import duration
from cartwheel.schemas import KEYS
from cartwheel.session import scratch_path
from cartwheel.sinks import keyed, partitions, zones
from cartwheel.sources.adapter import clickstream_from_events
from cartwheel.sources.tables import as_timestamp, dates_between, load_table, spread_small_input
from cartwheel.streaming.job import with_window_date

_STORED: dict = {}


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's events; a one-split file is spread over the task slots first."""
    return spread_small_input(load_table(spark, sf_dir, "events"))


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All adapted events, unvalidated (what the window aggregate sees)."""
    return clickstream_from_events(events_table(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated events: the content of the raw events table."""
    valid, _ = decode.validate(decoded(spark, sf_dir))
    return valid


def aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_counts(decoded(spark, sf_dir), P.WINDOW, P.SLIDE)


def alert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts; created_at is the window end (a deterministic stand-in for the batch clock)."""
    return alerts.flash_sale(aggregates(spark, sf_dir), P.MIN_VIEWS, P.MAX_PURCHASES,
                             created_at=F.col("window_end"))


def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.daily_top_products(raw_events(spark, sf_dir), P.START, P.END)


def segments(spark: SparkSession, sf_dir: str, three_way: bool = False) -> DataFrame:
    return daily.user_segments(raw_events(spark, sf_dir), P.START, P.END, three_way=three_way)


def conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.conversion_by_product(raw_events(spark, sf_dir), P.START, P.END)


def stored(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the five tables as the job and the daily jobs leave them; written once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        root = scratch_path(spark, "tables")
        by_date = (keyed.WINDOW_DATE,)
        events = raw_events(spark, sf_dir).withColumn("event_date", F.to_date("event_time"))
        keyed.write_log_rows(events, f"{root}/clickstream_events", 0, ("event_date",))
        keyed.upsert(with_window_date(aggregates(spark, sf_dir)), f"{root}/product_view_aggregates", 0, by_date)
        counts = keyed.current(spark, f"{root}/product_view_aggregates", KEYS["product_view_aggregates"])
        found = alerts.flash_sale(counts, P.MIN_VIEWS, P.MAX_PURCHASES, created_at=F.col("window_end"))
        keyed.upsert(with_window_date(found), f"{root}/flash_sale_alerts", 0, by_date)
        zones.record(spark, f"{root}/flash_sale_alerts", 0, keyed.WINDOW_DATE, "created_at")
        events = keyed.union_of_slices(spark, f"{root}/clickstream_events")
        partitions.replace_dates(spark, daily.user_segments(events, P.START, P.END), f"{root}/user_segments",
                                 "segment_date", P.START, P.END)
        partitions.replace_dates(spark, daily.daily_top_products(events, P.START, P.END),
                                 f"{root}/daily_product_report", "report_date", P.START, P.END)
        _STORED[key] = root
    return _STORED[key]


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.union_of_slices(spark, f"{stored(spark, sf_dir)}/clickstream_events").drop("event_date")


def stored_aggregates(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """All windows, or those of the date folders that hold windows ending in the range."""
    dates = dates_between(as_timestamp(start) - duration(P.WINDOW), end) if start is not None else None
    return keyed.current(spark, f"{stored(spark, sf_dir)}/product_view_aggregates", KEYS["product_view_aggregates"],
                         dates=dates)


def stored_alerts(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """All alerts, or those of the slices that the zone map names for the range of ``created_at``."""
    path, keys = f"{stored(spark, sf_dir)}/flash_sale_alerts", KEYS["flash_sale_alerts"]
    if start is None and end is None:
        return keyed.current(spark, path, keys)
    return zones.current_in_range(spark, path, keys, "created_at", start, end)


def stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{stored(spark, sf_dir)}/daily_product_report")


def stored_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{stored(spark, sf_dir)}/user_segments")
