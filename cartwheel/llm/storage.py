"""Shared-folder files for operators that write formats Spark has no writer for.

Tasks write under temporary names; what a successful task attempt wrote is listed in a manifest
that Spark's own writer commits; only listed files are renamed. Attempts that were lost leave
files that no manifest names, so a retried task never mixes with them.
"""

from __future__ import annotations

import ctypes
import json
import math
import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import scratch_path


def written_path(df: DataFrame, name: str) -> str:
    """A new shared folder with the rows of ``df``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives executors."""
    return df.sparkSession.read.schema(df.schema).parquet(written_path(df, name))


#: Rows and bytes in an Arrow batch: whole texts are long, and a batch stands in memory several times.
ARROW_ROWS, ARROW_BYTES = 1600, 8 << 20


_HELD: dict = {}


def held(key, make):
    """One object kept for each worker process over its tasks (a tokenizer and its tables); another one takes its place."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Drops what an earlier stage's operator keeps in this worker; functions that hold nothing start with it."""
    if _HELD:
        _HELD.clear()
        release()


def release() -> None:
    """Gives memory that a worker has freed back to the system: workers live on beside later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ship_package(spark: SparkSession) -> None:
    """Sends this package to Python workers that cannot import it, once for each Spark application, and
    bounds the session's Arrow batches by ``ARROW_ROWS`` and ``ARROW_BYTES``."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if home in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_cartwheel_shipped", False):
        return
    at = tempfile.mkdtemp(prefix="cartwheel-package-")
    sc.addPyFile(shutil.make_archive(f"{at}/cartwheel_package", "zip", home, "cartwheel"))
    sc._cartwheel_shipped = True


def open_fs(uri: str):
    """(filesystem, path) of a folder URI; a bare path is local."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else f"file://{uri}")


def folder_uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path


class RollingFiles:
    """Writes numbered files of one task; a file is closed once it holds ``max_bytes``."""

    def __init__(self, uri: str, part: int, suffix: str, max_bytes: int):
        self.fs, self.root = open_fs(uri)
        self.fs.create_dir(f"{self.root}/tmp", recursive=True)
        self.attempt = uuid.uuid4().hex
        self.part, self.suffix, self.max_bytes = part, suffix, max_bytes
        self.seq, self.out, self.size = 0, None, 0

    def open(self):
        self.tmp = f"tmp/{self.attempt}-{self.seq:05d}{self.suffix}"
        self.name = f"part-{self.part:06d}-{self.seq:05d}{self.suffix}"
        self.out, self.size = self.fs.open_output_stream(f"{self.root}/{self.tmp}", compression=None), 0

    def write(self, data: bytes) -> int:
        """Appends and returns the place of ``data`` in the file."""
        if self.out is None:
            self.open()
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return at

    @property
    def full(self) -> bool:
        return self.out is not None and self.size >= self.max_bytes

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        done = {"part": self.part, "seq": self.seq, "tmp": self.tmp, "name": self.name, "bytes": self.size}
        self.seq += 1
        return done


def commit_files(manifest: DataFrame, uri: str) -> None:
    """Renames the listed temporary files to their final names; safe to run again."""

    def rename(batches):
        fs, root = open_fs(uri)
        for batch in batches:
            for tmp, name in zip(batch["tmp"].to_pylist(), batch["name"].to_pylist()):
                there = fs.get_file_info(f"{root}/{name}").type != pafs.FileType.NotFound
                left = fs.get_file_info(f"{root}/{tmp}").type != pafs.FileType.NotFound
                if left:
                    fs.move(f"{root}/{tmp}", f"{root}/{name}")
                elif not there:
                    raise FileNotFoundError(f"{root}/{tmp}")
            yield batch.select(["name"])

    moved = manifest.select("tmp", "name").mapInArrow(rename, "name string")
    moved.agg(F.count("*")).collect()


#: Bytes that a range of a sorted table is meant to hold, the fewest ranges made of a table with as many rows, and the
#: rows that borders are drawn from: at least so many, and so many for each range.
RANGE_BYTES, FEWEST_RANGES, BORDER_ROWS, ROWS_A_RANGE = 2 << 30, 32, 1 << 15, 8
_HASHES = 1 << 40


def _rank(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(_HASHES))


def drawn(light: DataFrame, keys: list[str], rows: int, total: int) -> DataFrame:
    """About ``rows`` of the ``total`` rows, chosen by the hash of their keys alone: the same ones in every run."""
    return light.where(_rank(keys) < math.ceil(_HASHES * min(1.0, rows / max(total, 1))))


def ranges(light: DataFrame, keys: list[str], size: str) -> tuple[int, Column]:
    """How many ranges ``light`` is cut into when sorted by ``keys``, and the column with a row's range.

    Both depend on the rows alone, not on splits, settings or attempts: their number on the sum of ``size``,
    the borders on the sizes of rows drawn by hash. Rows with equal keys share a range.
    """
    rows, held = light.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    count = max(1, min(rows, max(FEWEST_RANGES, math.ceil(held / RANGE_BYTES))))
    some = drawn(light, keys, max(BORDER_ROWS, ROWS_A_RANGE * count), rows).groupBy(*keys).agg(F.sum(size).alias(size))
    some = some.orderBy(*keys).select(F.to_json(F.struct(*keys)).alias("key"), F.col(size).alias("size")).collect()
    step, below, borders = sum(r["size"] for r in some) / count, 0, []
    for r in some:
        if below >= step * (len(borders) + 1):
            borders.append(r["key"])
            while below >= step * (len(borders) + 1):  # one key fills several ranges: they stay empty
                borders.append(r["key"])
        below += r["size"]
    if not borders:
        return 1, F.lit(0)
    types = light.schema
    kind = "array<struct<" + ",".join(f"{k}:{types[k].dataType.simpleString()}" for k in keys) + ">>"
    table = F.from_json(F.lit("[" + ",".join(borders) + "]"), kind)
    steps = F.array(*[F.lit(1 << b) for b in range(len(borders).bit_length() - 1, -1, -1)])
    key = F.struct(*keys)
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(  # halving: how many borders are not above the key
        F.get(table, at + step - 1) <= key, at + step).otherwise(at))
    return len(borders) + 1, place


def shards(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
