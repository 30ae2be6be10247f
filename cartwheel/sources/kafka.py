"""Kafka source and sink.

The connector jar must be on the classpath (``--packages
org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>``). The decode that
follows the source takes any DataFrame with a binary or string ``value``, so
tests feed it from files instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import KafkaSettings


def read_stream(spark: SparkSession, settings: KafkaSettings, max_offsets_per_trigger=None,
                min_partitions=None) -> DataFrame:
    """``max_offsets_per_trigger`` bounds a micro-batch (default: the settings' bound);
    ``min_partitions`` splits the offset
    ranges of a topic with few partitions over more tasks (the decode then runs in parallel)."""
    reader = spark.readStream.format("kafka").options(**settings.source_options())
    bound = max_offsets_per_trigger or settings.max_offsets_per_trigger
    if bound:
        reader = reader.option("maxOffsetsPerTrigger", str(bound))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def read_replay(spark: SparkSession, settings: KafkaSettings) -> DataFrame:
    """Bounded replay of the whole topic, earliest to latest."""
    return (
        spark.read.format("kafka")
        .options(**settings.source_options(starting_offsets="earliest"))
        .option("endingOffsets", "latest")
        .load()
    )


def first_messages(records: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` messages in (partition, offset) order (L9); a limit is the feature here."""
    return records.orderBy("partition", "offset").limit(n)


# timestamps keep microseconds in JSON (the default format stops at milliseconds)
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_json_records(events: DataFrame, key_column: str | None = None) -> DataFrame:
    """Encode rows as Kafka records: ``value`` = UTF-8 JSON of all columns."""
    cols = [c for c in events.columns]
    key = F.col(key_column).cast("string") if key_column else F.lit(None).cast("string")
    return events.select(key.alias("key"), F.to_json(F.struct(*cols), JSON_OPTIONS).alias("value"))


def from_json_records(records: DataFrame, schema) -> DataFrame:
    """Decode ``value`` JSON written by :func:`to_json_records` back to typed columns."""
    return records.select(F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS).alias("e")) \
        .select("e.*")


def write_json_files(events: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None):
    """A stream as JSON files of Structured Streaming's file sink (K10): its commit log in the folder names the files of
    each micro-batch once, so a batch that is run again after a restart adds nothing."""
    return (events.writeStream.format("json").options(**JSON_OPTIONS)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"}))
            .outputMode("append").start(folder))


def read_json_files(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The typed rows of the committed files; files that a lost attempt left are not in the commit log."""
    return spark.read.schema(schema).options(**JSON_OPTIONS).json(folder)


def write_batch(events: DataFrame, settings: KafkaSettings, key_column: str | None = None) -> None:
    to_json_records(events, key_column).write.format("kafka").options(**settings.sink_options()).save()


def write_stream(events: DataFrame, settings: KafkaSettings, checkpoint: str, key_column=None):
    return (
        to_json_records(events, key_column).writeStream.format("kafka")
        .options(**settings.sink_options())
        .option("checkpointLocation", checkpoint)
        .start()
    )
