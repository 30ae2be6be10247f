"""Sliding windows from shared panes (T2, A1, T11): one state row per product and slide.

``window()`` keeps ``window/slide`` state rows for each event; panes keep one. The state is a tumbling count of
slide-sized panes, and a micro-batch's windows are summed from the open panes when they are written.

Open panes are a small table of slices: batch N is its changed panes and those of slice N-1 that an open window
still needs, so a batch reads one slice, however long the stream has run, and a second try reads the same one.
A slice goes when the next but one is written.

A window closes once its end is not after the latest event time of the *earlier* batches less the watermark delay;
from then on its row stays as it is. A late event still counts for those of its windows that are open. An event without a time
joins no pane.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.windows import duration, type_counts
from cartwheel.sinks import keyed

COUNTS = ("view_count", "cart_count", "purchase_count")
KEY = ("pane_start", "product_id")
SCHEMA = ("pane_start timestamp, product_id string, view_count long, cart_count long, purchase_count long, "
          "latest timestamp, changed boolean")


def check_sizes(window: str, slide: str) -> int:
    """Panes of a window; panes need a window of a whole number of slides."""
    number, rest = divmod(duration(window), duration(slide))
    if number < 1 or rest:
        raise ValueError(f"a window of {window} is no whole number of slides of {slide}")
    return number


def pane_counts(events: DataFrame, window: str, slide: str, watermark: str, time_col: str = "event_time") -> DataFrame:
    """Counts per (pane, product) with the latest event time, as a streaming aggregate.

    The delay is longer by ``window - slide``: a pane's state goes with the last window that holds the pane.
    """
    check_sizes(window, slide)
    delay = duration(watermark) + duration(window) - duration(slide)
    # an interval of seconds and microseconds, since a day of a Spark interval is not always 24 hours
    text = f"{delay.days * 86400 + delay.seconds} seconds {delay.microseconds} microseconds"
    counted = (events.withWatermark(time_col, text)
               .groupBy(F.window(time_col, slide).alias("pane"), "product_id")
               .agg(*type_counts(), F.max(time_col).alias("latest")))
    return counted.select(F.col("pane.start").alias("pane_start"), "product_id", *COUNTS, "latest")


def _later(column: Column, span: dt.timedelta) -> Column:
    return column + F.make_dt_interval(secs=F.lit(span.total_seconds()))


def merged_panes(changed: DataFrame, before: DataFrame | None, window: str, closed) -> DataFrame:
    """The open panes after a batch: changed ones with their new counts, the others as they were.

    Counts of a pane only grow, so the greatest is the newest: one aggregate, no join. ``closed`` is the time up to
    which windows are closed (None: none is).
    """
    rows = changed.withColumn("changed", F.lit(True))
    if before is not None:
        rows = rows.unionByName(before.withColumn("changed", F.lit(False)))
    if closed is not None:
        rows = rows.where(_later(F.col("pane_start"), duration(window)) > closed)
    return rows.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in (*COUNTS, "latest", "changed")])


def windows_of(panes: DataFrame, window: str, slide: str, closed) -> DataFrame:
    """The open windows that hold a changed pane, summed over all their panes."""
    number = check_sizes(window, slide)
    spread = panes.select("*", F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias("_back"))
    start = F.col("pane_start") - F.make_dt_interval(secs=F.col("_back") * F.lit(duration(slide).total_seconds()))
    found = spread.withColumn("window_start", start).withColumn(
        "window_end", _later(F.col("window_start"), duration(window)))
    if closed is not None:
        found = found.where(F.col("window_end") > closed)
    return (found.groupBy("window_start", "window_end", "product_id")
            .agg(*[F.sum(c).alias(c) for c in COUNTS], F.max("changed").alias("_changed"))
            .where("_changed").select("window_start", "window_end", "product_id", *COUNTS))


def batch_writer(spark: SparkSession, folder: str, window: str, slide: str, watermark: str, write_windows):
    """foreachBatch function over ``pane_counts``: keeps the open panes in ``folder`` and hands the batch's windows to
    ``write_windows(df, batch_id)``. ``folder`` belongs to one checkpoint."""

    def write(changed: DataFrame, batch_id: int) -> None:
        before = closed = None
        if batch_id > 0:
            before = spark.read.schema(SCHEMA).parquet(keyed.slice_path(folder, batch_id - 1))
            latest = before.agg(F.date_format(F.max("latest"), "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")).first()[0]
            if latest is not None:
                # the stream's own watermark counts in whole milliseconds
                closed = F.date_trunc("millisecond", F.lit(latest).cast("timestamp")) - F.make_dt_interval(
                    secs=F.lit(duration(watermark).total_seconds()))
        keyed.write_slice(merged_panes(changed, before, window, closed), folder, batch_id)
        panes = spark.read.schema(SCHEMA).parquet(keyed.slice_path(folder, batch_id))
        write_windows(windows_of(panes, window, slide, closed), batch_id)
        if batch_id > 1:
            keyed.drop_slice(spark, folder, batch_id - 2)

    return write
