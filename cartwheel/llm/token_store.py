"""Token-ID files: every document compressed alone with one shared zstandard dictionary.

A store is a folder::

    dictionary/        one row: the dictionary and its SHA-256 (Parquet)
    manifest/          one row for each file: name, bytes, documents, tokens, first token (Parquet)
    part-<p>-<q>.ids   documents in ascending id order

A file holds the compressed id arrays one after another, then an Arrow table (id, place, size,
tokens of each document), then a footer: JSON with the dictionary's hash, its length and a mark.
A short document is read by one ranged read and one small decompression.

Defined results: null text is the empty text (it still gets the end id); null ids come first;
rows with equal ids follow in the order of their texts' hashes, repeated rows all stay; the same rows give the
same files whatever the input's splits and the session's settings; an empty
table gives a store without files; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm import storage
from cartwheel.llm.tokens import encoder

MARK = b"IDSTORE1"
MANIFEST = "part int, seq int, tmp string, name string, bytes long, docs long, tokens long"
#: Documents the dictionary is trained on, and the ids taken of each; a bound, whatever the input's size. Both the
#: documents and the place of the ids in a long one are drawn by hash over all rows, the same ones in every run.
SAMPLE_DOCS, SAMPLE_IDS = 400, 4096
BATCH = 2048  # documents in an Arrow batch, so that long texts do not pile up in a worker


def train_dictionary(docs: DataFrame, tokenizer_path: str, size: int = 65536, id_col: str = "doc_id",
                     text_col: str = "text", light: DataFrame | None = None) -> bytes:
    """A dictionary fitted on the id arrays of at most ``SAMPLE_DOCS`` documents; empty if they are too few."""

    def sample(batches):
        for batch in batches:
            arrays = []
            for ids, rank in zip(encoder(tokenizer_path).encode_many(batch["text"].to_pylist()), batch["rank"].to_pylist()):
                width = encoder(tokenizer_path).dtype.itemsize
                at = rank % max(1, len(ids) // width - SAMPLE_IDS + 1) * width
                arrays.append(ids[at:at + SAMPLE_IDS * width])
            yield pa.RecordBatch.from_pydict({"rank": batch["rank"], "ids": pa.array(arrays, pa.binary())})

    light = _keys(_rows(docs, id_col, text_col)) if light is None else light
    some = storage.drawn(light, ["id", "tie"], 2 * SAMPLE_DOCS, light.count()).select("id", "tie").distinct()
    rank = F.xxhash64("tie", "id")
    some = some.withColumn("rank", rank).orderBy("rank").limit(SAMPLE_DOCS)
    rows, some = _rows(docs, id_col, text_col), some.toDF("key", "mark", "rank")
    texts = rows.join(F.broadcast(some), rows["id"].eqNullSafe(some["key"]) & (rows["tie"] == some["mark"]))
    texts = texts.select("rank", "text").dropDuplicates(["rank"])  # rows of a rank are equal
    arrays = [bytes(r["ids"]) for r in sorted(texts.mapInArrow(sample, "rank bigint, ids binary").collect())]
    try:
        return zstd.train_dictionary(size, [a for a in arrays if a]).as_bytes()
    except (zstd.ZstdError, ValueError):  # the trainer refuses few or tiny samples
        return b""


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("tie", F.xxhash64("text"))


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select("id", "tie", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"))


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
                text_col: str = "text", max_file_bytes: int = 64 << 20, level: int = 3) -> None:
    """Encodes whole texts, appends ``end_id`` to each, and writes the store in ascending id order."""
    spark = docs.sparkSession
    uri = storage.folder_uri(path)
    rows = _rows(docs, id_col, text_col)
    light = storage.written(_keys(rows), "document-keys")
    dictionary = train_dictionary(docs, tokenizer_path, id_col=id_col, text_col=text_col, light=light)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, dictionary binary").write.parquet(
        f"{path}/dictionary")

    def write(batches):
        enc = encoder(tokenizer_path)
        end = np.array([end_id], enc.dtype).tobytes()
        packer = zstd.ZstdCompressor(level=level, dict_data=zstd.ZstdCompressionDict(dictionary)) if dictionary else (
            zstd.ZstdCompressor(level=level))
        files = None
        index: dict[str, list] = {"id": [], "place": [], "size": [], "tokens": []}
        id_type = None

        def finish():
            table = pa.table({"id": pa.array(index["id"], id_type), **{
                k: pa.array(index[k], pa.int64()) for k in ("place", "size", "tokens")}})
            sink = io.BytesIO()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            body = sink.getvalue()
            foot = json.dumps({"dictionary": digest, "index": len(body), "width": enc.dtype.itemsize}).encode()
            files.write(body + foot + struct.pack("<I", len(foot)) + MARK)
            done = files.close() | {"docs": len(index["id"]), "tokens": sum(index["tokens"])}
            for column in index.values():
                column.clear()
            return pa.RecordBatch.from_pylist([{k: done[k] for k in names}], schema=schema)

        names = [c.split()[0] for c in MANIFEST.split(", ")]
        schema = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]])
                            for n, c in zip(names, MANIFEST.split(", "))])
        for batch in batches:
            id_type = batch.schema.field("id").type
            for at in range(0, batch.num_rows, BATCH):
                some = batch.slice(at, BATCH)
                for part, key, ids in zip(some["part"].to_pylist(), some["id"].to_pylist(),
                                          enc.encode_many(some["text"].to_pylist())):
                    if files is None or files.part != part:
                        if index["id"]:
                            yield finish()
                        files = storage.RollingFiles(uri, part, ".ids", max_file_bytes)
                    ids += end
                    frame = packer.compress(ids)
                    index["place"].append(files.write(frame))
                    index["id"].append(key)
                    index["size"].append(len(frame))
                    index["tokens"].append(len(ids) // enc.dtype.itemsize)
                    if files.full:
                        yield finish()
            storage.release()
        if index["id"]:
            yield finish()

    count, part = storage.ranges(light, ["id", "tie"], "size")
    ordered = (rows.withColumn("part", part).repartitionById(count, F.col("part"))
               .sortWithinPartitions("part", "id", "tie").select("part", "id", "text"))
    staged = storage.written(ordered.mapInArrow(write, MANIFEST), "ids-staged")
    storage.commit_files(staged, uri)
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    staged.select("part", "seq", "name", "bytes", "docs", "tokens", F.coalesce(
        F.sum("tokens").over(order), F.lit(0)).alias("start")).write.parquet(f"{path}/manifest")


@lru_cache(maxsize=4)
def _opener(dictionary: bytes) -> zstd.ZstdDecompressor:
    return zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(dictionary)) if dictionary else (
        zstd.ZstdDecompressor())


def load_dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(bytes(row["dictionary"])).hexdigest() != row["sha256"]:
        raise ValueError("the stored dictionary does not match its hash")
    return bytes(row["dictionary"])


class StoreFile:
    """One file of a store, opened for ranged reads."""

    def __init__(self, uri: str, name: str, dictionary: bytes):
        fs, root = storage.open_fs(uri)
        self.file = fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        tail = self.file.read_at(min(size, 4096), size - min(size, 4096))
        if tail[-8:] != MARK:
            raise ValueError(f"{name}: cut off or not an id file")
        (length,) = struct.unpack("<I", tail[-12:-8])
        foot = json.loads(tail[-12 - length:-12])
        if foot["dictionary"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError(f"{name}: written with another dictionary")
        self.dtype = np.dtype(f"<u{foot['width']}")
        body = self.file.read_at(foot["index"], size - 12 - length - foot["index"])
        self.index = pa.ipc.open_stream(body).read_all()
        self.opener = _opener(dictionary)

    def ids(self, row: int) -> np.ndarray:
        """The ids of the document in ``row`` of the index."""
        at, size = self.index["place"][row].as_py(), self.index["size"][row].as_py()
        return np.frombuffer(self.opener.decompress(self.file.read_at(size, at)), self.dtype)

    def close(self):
        self.file.close()


def read_store(spark: SparkSession, path: str, id_type: str = "bigint", content: str = "ids") -> DataFrame:
    """Documents of a store: ``doc_id, start, n_tokens`` and ``ids`` (array) or, by ``content='crc32'``,
    ``ids_crc32`` of the ids as little-endian unsigned 32-bit integers."""
    uri, dictionary = storage.folder_uri(path), load_dictionary(spark, path)
    last, kind = ("ids", "array<int>") if content == "ids" else ("ids_crc32", "bigint")

    def read(batches):
        for batch in batches:
            for name, start in zip(batch["name"].to_pylist(), batch["start"].to_pylist()):
                file = StoreFile(uri, name, dictionary)
                keys, counts = file.index["id"], file.index["tokens"].to_numpy()
                starts = start + np.concatenate([[0], np.cumsum(counts)[:-1]])
                for at in range(0, len(keys), BATCH):
                    here = range(at, min(at + BATCH, len(keys)))
                    arrays = [file.ids(i).astype("<u4") for i in here]
                    out = (pa.array([a.view("<i4") for a in arrays], pa.list_(pa.int32())) if content == "ids"
                           else pa.array([zlib.crc32(a.tobytes()) for a in arrays], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(at, BATCH).combine_chunks(), pa.array(starts[at:at + BATCH], pa.int64()),
                         pa.array(counts[at:at + BATCH], pa.int64()), out], ["doc_id", "start", "n_tokens", last])
                file.close()

    files = spark.read.parquet(f"{path}/manifest").select("name", "start")
    return files.repartition(storage.shards(spark), "name").mapInArrow(
        read, f"doc_id {id_type}, start bigint, n_tokens bigint, {last} {kind}")
