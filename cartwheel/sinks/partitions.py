"""Replace whole date partitions of a stored table (K4, K5): DELETE date + INSERT, atomically per date.

Dynamic partition overwrite replaces the dates that have rows; dates of the range
without rows are cleared explicitly, since dynamic overwrite would leave their old
rows in place.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.tables import as_timestamp, dates_of


def replace_dates(
    spark: SparkSession, df: DataFrame, table_path: str, date_col: str, start, end
) -> list[dt.date]:
    """Make ``table_path`` hold exactly ``df``'s rows for every date of ``[start, end)``.

    Other dates are untouched. Returns the dates that were cleared for lack of rows.
    """
    # range partitioning on (date, next column): a large date spreads over several tasks and
    # files, a small one stays in one file
    spread = [date_col] + [c for c in df.columns if c != date_col][:1]
    # the dates written are gathered while writing (a set of at most one value per day),
    # so the result is computed once
    seen = Observation(f"dates_{uuid.uuid4().hex}")
    (
        df.observe(seen, F.collect_set(F.col(date_col)).alias("dates"))
        .repartitionByRange(*spread)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(table_path)
    )
    try:
        present = set(seen.get["dates"])
    except Exception:  # noqa: BLE001 - AQE skips the metrics of an empty range-partitioned input
        # exact fallback (an empty result: nothing was written, the query finds that cheaply)
        present = {r[0] for r in df.select(date_col).distinct().collect()}
    cleared = [d for d in dates_of(start, end) if d not in present]
    empty = spark.createDataFrame([], df.drop(date_col).schema)
    for d in cleared:
        empty.write.mode("overwrite").parquet(f"{table_path}/{date_col}={d.isoformat()}")
    return cleared


def read_dates(spark: SparkSession, table_path: str, date_col: str, start=None, end=None) -> DataFrame:
    """Rows of the dates of ``[start, end)``, a partial last day included."""
    df = spark.read.parquet(table_path)
    if start is not None:
        df = df.where(F.col(date_col) >= F.lit(as_timestamp(start).date()))
    if end is not None:
        past = as_timestamp(end) + dt.timedelta(days=1) - dt.timedelta(microseconds=1)
        df = df.where(F.col(date_col) < F.lit(past.date()))
    return df
