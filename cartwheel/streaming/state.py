"""The state of a streaming query as a table, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """``key, value, partition_id`` of a stateful operator after a batch (the last committed one by default)."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: name, number of partitions, least and greatest batch with state."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that the window query still counts: those whose end the watermark has not passed."""
    # the state's counters all have one name, so they are told by place
    counts = F.col("value").cast("struct<view_count:bigint,cart_count:bigint,purchase_count:bigint>")
    return state_rows(spark, checkpoint).select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
        F.col("key.product_id").alias("product_id"), counts.alias("counts")).select(
            "window_start", "window_end", "product_id", "counts.*")


def open_panes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The panes in the state of a job with shared panes: those of which the watermark has not passed every window."""
    counts = F.col("value").cast("struct<view_count:bigint,cart_count:bigint,purchase_count:bigint,latest:timestamp>")
    return state_rows(spark, checkpoint).select(
        F.col("key.window.start").alias("pane_start"), F.col("key.product_id").alias("product_id"),
        counts.alias("counts")).select("pane_start", "product_id", "counts.*")
