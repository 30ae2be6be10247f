"""Event-time sliding-window counts per product."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel import constants as C
from cartwheel.functions.rates import conversion_rate


def type_counts():
    """Conditional counts of the three event types (A1)."""
    return [
        F.count_if(F.col("event_type") == "view").alias("view_count"),
        F.count_if(F.col("event_type") == "add_to_cart").alias("cart_count"),
        F.count_if(F.col("event_type") == "purchase").alias("purchase_count"),
    ]


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(duration: str) -> int | None:
    """Seconds of a window duration like ``"10 minutes"``; None for other shapes."""
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", duration.lower())
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2)] if m else None


def duration(text: str) -> dt.timedelta:
    """A window duration as a time span."""
    seconds = _seconds(text)
    if seconds is None:
        raise ValueError(f"not a duration of seconds, minutes, hours or days: {text!r}")
    return dt.timedelta(seconds=seconds)


def bucketed_window_sums(
    events: DataFrame, window: str, slide: str, time_col: str, keys, aggregates
) -> DataFrame | None:
    """Sliding-window aggregates computed from slide-sized buckets (batch only).

    When the window is a whole number of slides, every event of one slide bucket lies
    in the same windows. So the events are first aggregated per (bucket, keys) - one
    pass, combined map-side - and only the bucket rows are spread over their
    ``window/slide`` windows and summed: the per-event work is a single hash aggregate
    instead of ``window/slide`` of them. Same windows as ``window()`` (epoch aligned,
    half-open; a NULL time joins none). Returns None when the sizes don't divide.
    """
    w, s = _seconds(window), _seconds(slide)
    if not w or not s or w % s:
        return None
    buckets = (
        events.where(F.col(time_col).isNotNull())
        .groupBy(F.window(time_col, slide).getField("start").alias("_bucket"), *keys)
        .agg(*aggregates)
    )
    names = [c for c in buckets.columns if c != "_bucket" and c not in keys]
    spread = buckets.select("*", F.explode(F.sequence(F.lit(0), F.lit(w // s - 1))).alias("_k"))
    start = F.col("_bucket") - F.make_dt_interval(secs=F.col("_k") * F.lit(s))
    return (
        spread.groupBy(start.alias("window_start"), *keys)
        # a group holds at least one bucket row: the sums are never NULL (kept non-nullable)
        .agg(*[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in names])
        .select(
            "window_start",
            (F.col("window_start") + F.make_dt_interval(secs=F.lit(w))).alias("window_end"),
            *keys,
            *names,
        )
    )


def sliding_counts(
    events: DataFrame,
    window: str = C.WINDOW_DURATION,
    slide: str = C.SLIDE_DURATION,
    time_col: str = "event_time",
    watermark: str | None = None,
    computed_at=None,
) -> DataFrame:
    """Views, cart additions and purchases per (window, product).

    Windows are half-open and epoch aligned; each event lands in ``window/slide``
    windows (an Expand before the partial aggregate, so the shuffle carries one row
    per window and product per task, however hot a product is). A NULL event time
    joins no window. With ``watermark`` set the result is a streaming aggregate whose
    state is dropped once a window's end passes the watermark. Pass ``computed_at``
    (a Column, e.g. ``current_timestamp()``) to stamp rows. A bounded input without
    watermark is counted per slide bucket first (``bucketed_window_sums``).
    """
    counted = ["view_count", "cart_count", "purchase_count"]
    bucketed = None if watermark or events.isStreaming else bucketed_window_sums(
        events, window, slide, time_col, ["product_id"], type_counts())
    if bucketed is not None:
        cols = ["window_start", "window_end", "product_id", *counted]
        if computed_at is not None:
            cols.append(computed_at.alias("computed_at"))
        return bucketed.select(*cols)
    src = events.withWatermark(time_col, watermark) if watermark else events
    agg = src.groupBy(F.window(time_col, window, slide).alias("window"), "product_id").agg(*type_counts())
    cols = [
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "product_id",
        *counted,
    ]
    if computed_at is not None:
        cols.append(computed_at.alias("computed_at"))
    return agg.select(*cols)


def window_event_type_counts(
    events: DataFrame, window: str = "10 minutes", slide: str = "2 minutes",
    time_col: str = "event_time", watermark: str | None = None,
) -> DataFrame:
    """Long form: one row per (window, product, event type) with its count."""
    if not watermark and not events.isStreaming:
        bucketed = bucketed_window_sums(events, window, slide, time_col, ["product_id", "event_type"],
                                        [F.count(F.lit(1)).alias("event_count")])
        if bucketed is not None:
            return bucketed
    src = events.withWatermark(time_col, watermark) if watermark else events
    return (
        src.groupBy(F.window(time_col, window, slide).alias("window"), "product_id", "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "product_id",
            "event_type",
            "event_count",
        )
    )


def with_window_conversion(aggregates: DataFrame) -> DataFrame:
    """Window aggregates with their conversion rate stored alongside."""
    return aggregates.withColumn(
        "conversion_rate", conversion_rate("purchase_count", "view_count")
    )
