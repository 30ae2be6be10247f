"""Records of a topic stored by partition, in files with known offset bounds.

A delivery is a slice ``batch=<n>``; its rows are range-partitioned by (partition, offset), so files of a
partition in one delivery do not overlap. Least and greatest offset and the rows of each file are a small table beside the log,
``<path>.bounds``. A bounded replay or the first N messages then open the files that may hold them and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ("partition", "offset")
BOUNDS = "partition int, path string, first long, last long, rows long"


def write(records: DataFrame, path: str, batch: int = 0, rows_per_file: int = 1_000_000, parts: int | None = None) -> None:
    """Stores a delivery (a second try replaces it). ``parts`` is the number of ranges, by default
    ``spark.sql.shuffle.partitions``; a range is cut into files of ``rows_per_file``."""
    spark = records.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slice_ = f"{path}/batch={int(batch)}"
    # the partition stays in the rows: folders give it for pruning under a name of its own
    (
        records.repartitionByRange(parts, *ORDER)
        .sortWithinPartitions(*ORDER)
        .withColumn("_partition", F.col("partition"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", int(rows_per_file))
        .partitionBy("_partition")
        .parquet(slice_)
    )
    found = spark.read.schema(records.schema).parquet(slice_).select(*ORDER, F.col("_metadata.file_path").alias("path"))
    (
        found.groupBy("path")
        .agg(F.first("partition").cast("int").alias("partition"), F.min("offset").cast("long").alias("first"),
             F.max("offset").cast("long").alias("last"), F.count("*").alias("rows"))
        .select("partition", "path", "first", "last", "rows")
        .write.mode("overwrite").parquet(f"{path}.bounds/batch={int(batch)}")
    )


def bounds(spark: SparkSession, path: str) -> DataFrame:
    """``partition, path, first, last, rows`` of every file."""
    return spark.read.schema(BOUNDS).option("recursiveFileLookup", "true").parquet(f"{path}.bounds")


def _rows(spark: SparkSession, schema, paths: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def first_messages(spark: SparkSession, path: str, schema, n: int = 5) -> DataFrame:
    """First ``n`` messages in (partition, offset) order; a limit is the feature here.

    The files that end first are taken until they hold ``n`` rows (at most ``n`` files, since each has a row): no
    message after their last one is asked for, so only files that begin before it are opened. Deliveries may overlap.
    """
    found, held, last = bounds(spark, path), 0, None
    for file in found.orderBy("partition", "last").limit(n).collect():
        held, last = held + file["rows"], file
        if held >= n:
            break
    if last is None:
        return _rows(spark, schema, [])
    asked = F.struct("partition", F.col("first").alias("offset")) <= F.struct(
        F.lit(last["partition"]).alias("partition"), F.lit(last["last"]).alias("offset"))
    paths = [r["path"] for r in found.where(asked).select("path").collect()]
    return _rows(spark, schema, paths).orderBy(*ORDER).limit(n)


def read_replay(spark: SparkSession, path: str, schema, starting: dict | None = None, ending: dict | None = None) -> DataFrame:
    """Bounded replay: of each partition the offsets from ``starting`` (included) to ``ending`` (left out); a partition that
    is not named is read from its beginning, or to its end. Files without such offsets are not opened."""
    def limit(given):
        pairs = [x for p, o in (given or {}).items() for x in (F.lit(int(p)), F.lit(int(o)))]
        return F.create_map(*pairs)[F.col("partition")] if pairs else F.lit(None).cast("long")

    begin, end = limit(starting), limit(ending)
    held = bounds(spark, path).where((begin.isNull() | (F.col("last") >= begin)) & (end.isNull() | (F.col("first") < end)))
    paths = [r["path"] for r in held.select("path").collect()]
    return _rows(spark, schema, paths).where((begin.isNull() | (F.col("offset") >= begin))
                                             & (end.isNull() | (F.col("offset") < end)))
