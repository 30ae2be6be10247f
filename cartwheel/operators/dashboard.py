"""Dashboard panel queries over the stored tables (J6: A6-A11, U1, P7-P9, L4-L8, X14, X15).

Time ranges are closed at both ends as the dashboard macro is; ``as_of_date``
replaces CURRENT_DATE (scheduled tables are keyed by the interval's start date).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel import constants as C
from cartwheel.functions.bands import alert_count_status, conversion_status, segment_colour
from cartwheel.functions.rates import conversion_rate
from cartwheel.sources.tables import as_timestamp, in_closed_range


def _as_of(as_of_date):
    if as_of_date is None:
        return F.current_date()
    return F.lit(as_timestamp(as_of_date).date() if not isinstance(as_of_date, dt.date) else as_of_date)


def views_series(aggregates: DataFrame, start=None, end=None) -> DataFrame:
    """time, metric (product), value (views), ordered by time."""
    return (
        in_closed_range(aggregates, start, end, "window_end")
        .select(
            F.col("window_end").alias("time"),
            F.col("product_id").alias("metric"),
            F.col("view_count").alias("value"),
        )
        .orderBy("time", "metric")
    )


def views_legend(series: DataFrame) -> DataFrame:
    """Legend statistics per series: max and mean."""
    return series.groupBy("metric").agg(
        F.max("value").alias("max_value"), F.avg("value").alias("mean_value")
    )


def funnel(aggregates: DataFrame, start=None, end=None) -> DataFrame:
    """Views / Add to Cart / Purchases summed per window end, long form.

    One scan and one aggregate; ``stack`` turns the three sums into rows instead
    of three separately aggregated branches.
    """
    sums = (
        in_closed_range(aggregates, start, end, "window_end")
        .groupBy("window_end")
        .agg(
            F.sum("view_count").alias("v"),
            F.sum("cart_count").alias("c"),
            F.sum("purchase_count").alias("p"),
        )
    )
    labels = C.FUNNEL_LABELS
    return sums.select(
        F.col("window_end").alias("time"),
        F.expr(
            f"stack(3, '{labels[0]}', v, '{labels[1]}', c, '{labels[2]}', p) as (metric, value)"
        ),
    ).orderBy("time", "metric")


def alert_count(alerts: DataFrame, start=None, end=None, time_col: str = "created_at") -> DataFrame:
    """Number of alerts in range with its colour band."""
    return (
        in_closed_range(alerts, start, end, time_col)
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .withColumn("status", alert_count_status(F.col("alert_count")))
    )


def alert_log(alerts: DataFrame, start=None, end=None, limit: int = C.ALERT_LOG_LIMIT,
              time_col: str = "created_at", display: bool = False) -> DataFrame:
    """Newest alerts first (L5, P9); ties broken by product and window for a stable page."""
    out = (
        in_closed_range(alerts, start, end, time_col)
        .orderBy(F.desc(time_col), F.asc("product_id"), F.asc("window_start"))
        .limit(limit)
        .select("product_id", "view_count", "purchase_count", "alert_message", time_col)
    )
    return rename_for_display(out) if display else out


def alert_annotations(alerts: DataFrame, start=None, end=None, time_col: str = "created_at") -> DataFrame:
    """time, text, tags markers for the time-series panels."""
    return (
        in_closed_range(alerts, start, end, time_col)
        .select(
            F.col(time_col).alias("time"),
            F.concat(F.col("product_id"), F.lit(C.ANNOTATION_SUFFIX)).alias("text"),
            F.lit(C.ANNOTATION_TAG).alias("tags"),
            "product_id",
            "window_start",
        )
        .orderBy("time", "product_id", "window_start")
    )


def conversion_top(aggregates: DataFrame, start=None, end=None, limit: int = C.CONVERSION_TOP_LIMIT) -> DataFrame:
    """Ratio of summed purchases to summed views per product, top ``limit``.

    Sums over overlapping windows count an event once per window; the ratio is
    what the panel shows. Ties are broken by product for a stable result.
    """
    sums = in_closed_range(aggregates, start, end, "window_end").groupBy("product_id").agg(
        F.sum("view_count").alias("views"), F.sum("purchase_count").alias("purchases")
    )
    return (
        sums.select(
            F.col("product_id").alias("metric"),
            conversion_rate("purchases", "views").alias("value"),
        )
        .orderBy(F.desc("value"), F.asc("metric"))
        .limit(limit)
        .withColumn("status", conversion_status(F.col("value")))
    )


def daily_top(report: DataFrame, as_of_date=None, limit: int = C.DAILY_PANEL_LIMIT) -> DataFrame:
    """The stored daily report of one date by rank."""
    return (
        report.where(F.col("report_date") == _as_of(as_of_date))
        .orderBy("rank")
        .limit(limit)
        .select("rank", "product_id", "total_views", "total_purchases", "conversion_rate")
    )


def segment_count(segments: DataFrame, segment: str, as_of_date=None) -> DataFrame:
    """Users of one segment on one date."""
    return (
        segments.where((F.col("segment_date") == _as_of(as_of_date)) & (F.col("segment") == F.lit(segment)))
        .agg(F.count(F.lit(1)).alias("users"))
    )


def segment_detail(segments: DataFrame, as_of_date=None, limit: int = C.SEGMENT_DETAIL_LIMIT) -> DataFrame:
    """Most active users of a date: purchases desc, views desc, user."""
    return (
        segments.where(F.col("segment_date") == _as_of(as_of_date))
        .orderBy(F.desc("total_purchases"), F.desc("total_views"), F.asc("user_id"))
        .limit(limit)
        .select("segment_date", "user_id", "segment", "total_views", "total_purchases")
        .withColumn("colour", segment_colour(F.col("segment")))
    )


def table_counts(tables: dict) -> DataFrame:
    """Row count of each stored table (A10)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rename_for_display(df: DataFrame) -> DataFrame:
    """Display names of the dashboard tables."""
    return df.withColumnsRenamed({k: v for k, v in C.DISPLAY_NAMES.items() if k in df.columns})
