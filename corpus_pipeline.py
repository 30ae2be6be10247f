"""The corpus pipeline: from raw documents to packed sequences.

Toxic documents go; recurring lines go but for their first document; of each group of near-duplicates one document
stays; benchmark passages are cut out (documents that are mostly benchmark go); the rest is packed. Each
stage works on all that the one before it kept. Stages that change texts keep ``n_chars`` in step.
Nulls, empty texts, repeated rows and other columns are taken as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, line_dedup, packing, simhash, storage, toxicity
from cartwheel.llm.queries import TOKENIZER, fold


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length(F.col("text").cast("string")).cast(kind))


#: Rows in a column batch of the Parquet reader and bytes in a row group of the writer: whole texts are long,
#: and what reader and writer hold stays in the executors' heaps beside the Python workers of every stage.
READER_ROWS, ROW_GROUP = 512, 16 << 20
#: Bytes of an Arrow batch and of a worker's table of encoded chunks: short tasks leave more workers alive than cores.
ARROW_BYTES, TABLE_BYTES = 4 << 20, 24 << 20


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
    spark.conf.set("parquet.block.size", str(ROW_GROUP))
    storage.ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    net = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), usable=fold(3) != 1)
    return toxicity.keep_clean(docs, net, threshold=0.7)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    return _counted(line_dedup.dedup(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    return _counted(decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    parts = packing.pieces(docs, TOKENIZER, capacity=1024, end_id=2, content="crc32", table_bytes=TABLE_BYTES)
    return packing.pack(parts, capacity=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("best_fit_packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = storage.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
