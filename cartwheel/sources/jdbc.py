"""JDBC scan of a stored table (S3).

For large tables give a numeric ``partition_column`` with bounds so the read is
split over ``num_partitions`` tasks; filters written after the read are pushed
into the database query by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    if partition_column:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=properties,
        )
    return spark.read.jdbc(url, table, properties=properties)


def write_table(df: DataFrame, url: str, table: str, properties: dict,
                mode: str = "append", batch_size: int = 500) -> None:
    """Executor-side batched insert (K11): each task writes its rows, 500 per batch."""
    df.write.option("batchsize", str(batch_size)).jdbc(url, table, mode=mode, properties=properties)
