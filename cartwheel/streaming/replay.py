"""Replay of stored records as a file stream with fixed micro-batch borders.

Records are dealt to slices of days once, as many files; a slice is then put before the
stream and the job run over all that is new (``availableNow``), one pass a slice on the same
checkpoint, so the borders are fixed whatever the number of files. In production the same
job replays from Kafka (earliest offsets).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.tables import as_timestamp


def slice_index(ts_col: str, first_day, days_per_batch: int, slices: int):
    """The slice of a record; the first and the last one are open-ended, and take records without a time first."""
    day0 = F.lit(as_timestamp(first_day).date())
    index = F.floor(F.datediff(F.to_date(F.col(ts_col)), day0) / F.lit(days_per_batch)).cast("int")
    return F.coalesce(F.least(F.greatest(index, F.lit(0)), F.lit(slices - 1)), F.lit(0))


def deal_slices(records: DataFrame, staged: str, first_day, last_day, days_per_batch: int,
                ts_col: str = "timestamp") -> int:
    """Write every record once under its slice's folder in ``staged``; returns the number of slices."""
    n_days = (as_timestamp(last_day).date() - as_timestamp(first_day).date()).days
    n_slices = max(1, -(-n_days // days_per_batch))
    index = slice_index(ts_col, first_day, days_per_batch, n_slices)
    records.withColumn("_slice", index).write.partitionBy("_slice").parquet(staged)
    return n_slices


def put_slice(spark: SparkSession, staged: str, folder: str, number: int, place: int, schema) -> None:
    """Put slice ``number`` before the stream as delivery ``place``; an empty slice adds no files."""
    rows = spark.read.schema(schema).parquet(f"{staged}/_slice={number}")
    rows.write.mode("overwrite").parquet(f"{folder}/part={place:05d}")


def deliveries(n_slices: int, redeliver_first: bool = False) -> list[int]:
    """Slices in the order they arrive; ``redeliver_first`` brings the first one again at the end,
    as an at-least-once source would after a restart (duplicates, late rows)."""
    return list(range(n_slices)) + ([0] if redeliver_first else [])


def read_slices(spark: SparkSession, folder: str, schema, files_per_trigger: int | None = 1) -> DataFrame:
    """The written files as a stream, oldest first; None takes all new files as one micro-batch."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)
