"""Constraint checks re-aimed from the stored tables' DDL (Q3, Q5, Q7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel import constants as C


def key_report(tables: dict, keys: dict) -> DataFrame:
    """One row per table: rows, distinct keys and keys held more than once (Q5)."""
    parts = []
    for name, df in tables.items():
        k = keys[name]
        per_key = df.groupBy(*k).agg(F.count(F.lit(1)).alias("copies"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("row_count"),
                F.count(F.lit(1)).alias("distinct_keys"),
                F.count_if(F.col("copies") > 1).alias("duplicate_keys"),
            ).select(F.lit(name).alias("table_name"), F.lit(",".join(k)).alias("key_columns"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def segment_domain(segments: DataFrame, allowed=C.SEGMENTS) -> DataFrame:
    """Per date and segment label: rows and whether the label is in the allowed domain (Q3)."""
    return (
        segments.groupBy("segment_date", "segment")
        .agg(F.count(F.lit(1)).alias("users"))
        .withColumn("in_domain", F.col("segment").isin(*allowed))
    )


def rate_fits(df: DataFrame, rate_col: str = "conversion_rate", precision: int = 6, scale: int = 4) -> DataFrame:
    """Flag rates that a DECIMAL(6,4) column can not hold (ratio >= 100) (Q7)."""
    return df.withColumn(
        "fits_decimal", F.col(rate_col).try_cast(f"decimal({precision},{scale})").isNotNull()
    )
