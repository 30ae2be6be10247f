"""WARC archives: a deterministic sharded writer and its reader.

Records are range-sorted by id and written by one task a range; a file is rolled once its compressed size
passes a bound. Each record is a gzip member of its own with regenerated headers, a SHA-1 digest of
its payload and ids derived from the row. Number and borders of the ranges depend on the rows alone
(:func:`storage.ranges`), so the same rows give the same files whatever the input's splits and the session's
settings. Files are written under temporary names; the manifest decides which attempts count, and only those are renamed.

Of records with equal payloads of at least ``min_revisit`` bytes, that with the largest id is the
response and the others revisit it. Copies are found over ids, digests and sizes only. A small row that says
what to revisit goes into the range sort beside the pages, just before its page, so payloads cross
one shuffle and never meet by digest.

Defined results: null html is the empty payload; null urls are left out; records with a null id are written first,
and revisit a copy that has an id, if any; rows that share a payload's largest id are all responses;
repeated rows all stay; an empty table gives archives without records; other columns are
ignored whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import storage

MANIFEST = "part int, seq int, tmp string, name string, bytes long, records long, sha256 string"
NAMES = [c.split()[0] for c in MANIFEST.split(", ")]
ID_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
READ = 1 << 20


def record_id(key, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(ID_SPACE, f'{key}:{digest}')}>"


def record(key, url: str | None, payload: bytes, digest: str, target, date: str) -> bytes:
    """One record; ``target`` is the id of the row that it revisits, or None for a response."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if target is not None else http + payload
    block_sha = base64.b32encode(hashlib.sha1(block).digest()).decode()
    payload_sha = base64.b32encode(bytes.fromhex(digest)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if target is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(key, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if key is not None:
        head.append(f"X-Row-ID: {key}")
    if target is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(target, digest)}", f"X-Refers-To-Row-ID: {target}"]
    head += [f"WARC-Payload-Digest: sha1:{payload_sha}", f"WARC-Block-Digest: sha1:{block_sha}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzipped(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_revisit: int = 1000, max_file_bytes: int = 256 << 20, level: int = 6,
                   date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes ``pages`` as archives with their manifest under ``path``."""
    spark = pages.sparkSession
    uri = storage.folder_uri(path)
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("tie", F.xxhash64("digest", "url"))
    light = storage.written(rows.select("id", "tie", "digest", F.octet_length("payload").cast("bigint").alias("size")), "payloads")
    copied = (light.where(F.col("size") >= min_revisit).groupBy("digest")
              .agg(F.count("*").alias("copies"), F.max("id").alias("response")).where("copies > 1 and response is not null"))
    revisits = (light.join(copied.select("digest", "response"), "digest").where(~F.col("id").eqNullSafe(F.col("response")))
                .select("id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
                        "digest", "tie", "response"))

    def write(batches):
        files = None
        hashed, count, decided = hashlib.sha256(), 0, None
        schema = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]])
                            for n, c in zip(NAMES, MANIFEST.split(", "))])

        def finish():
            done = files.close() | {"records": count, "sha256": hashed.hexdigest()}
            return pa.RecordBatch.from_pylist([{n: done[n] for n in NAMES}], schema=schema)

        def put(data):
            files.write(data)
            hashed.update(data)

        for batch in batches:
            columns = [batch[n] for n in ("part", "id", "url", "payload", "digest", "response")]
            for i in range(batch.num_rows):
                part, key, url, body, digest, response = (c[i].as_py() for c in columns)
                if body is None:
                    decided = (key, digest, response)
                    continue
                target = decided[2] if decided is not None and decided[:2] == (key, digest) else None
                if files is None or files.part != part:
                    if files is not None and files.out is not None:
                        yield finish()
                    files = storage.RollingFiles(uri, part, ".warc.gz", max_file_bytes)
                if files.out is None:
                    hashed, count = hashlib.sha256(), 0
                    put(gzipped(_file_info(files, date), level))
                put(gzipped(record(key, url, body, digest, target, date), level))
                count += 1
                if files.full:
                    yield finish()
        if files is not None and files.out is not None:
            yield finish()

    count, part = storage.ranges(light, ["id", "tie"], "size")
    both = rows.withColumn("response", F.lit(None).cast(light.schema["id"].dataType)).unionByName(revisits)
    ordered = (both.withColumn("part", part).repartitionById(count, F.col("part"))
               .sortWithinPartitions("part", "id", "tie", "digest", F.col("payload").isNotNull())
               .select("part", "id", "url", "payload", "digest", "response"))
    staged = storage.written(ordered.mapInArrow(write, MANIFEST), "archives-staged")
    storage.commit_files(staged, uri)
    staged.drop("tmp").write.parquet(f"{path}/manifest")


def _file_info(files: storage.RollingFiles, date: str) -> bytes:
    """The record that opens a file. Its id is the place of the file, so a rerun writes the same bytes."""
    block = b"software: cartwheel\r\nformat: WARC File Format 1.1\r\n"
    name = f"part-{files.part:06d}-{files.seq:05d}.warc.gz"
    return ("WARC/1.1\r\nWARC-Type: warcinfo\r\n" f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(ID_SPACE, name)}>\r\n"
            f"WARC-Date: {date}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\n"
            f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def members(stream):
    """Contents of the gzip members of a file, one after another, read in blocks."""
    unpacker, parts = zlib.decompressobj(31), []
    data = stream.read(READ)
    while data:
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(parts)
            data, unpacker, parts = unpacker.unused_data or stream.read(READ), zlib.decompressobj(31), []
        else:
            data = stream.read(READ)
    if parts:
        raise ValueError("the last record is cut off")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint", content: bool = False) -> DataFrame:
    """``id, url, record_type, refers_to, payload_bytes, payload_digest`` of every record, checked against its
    headers; with ``content`` also ``payload`` (null for revisits)."""
    uri = storage.folder_uri(path)
    kind = "string" if id_type == "string" else id_type
    schema = "id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string"
    if content:
        schema += ", payload binary"
    names = [c.split()[0] for c in schema.split(", ")]
    types = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string())
                       for n in names])

    def row(fields: dict[str, str], block: bytes):
        sha = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        if sha(block) != fields["WARC-Block-Digest"]:
            raise ValueError(f"{fields['WARC-Record-ID']}: the block does not match its digest")
        http, _, body = block.partition(b"\r\n\r\n")
        stated = fields["WARC-Payload-Digest"]
        size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
        if fields["WARC-Type"] == "response" and (sha(body) != stated or size != len(body)):
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
        return {"id": fields.get("X-Row-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
                "refers_to": fields.get("X-Refers-To-Row-ID"), "payload_bytes": size,
                "payload_digest": base64.b32decode(stated[5:]).hex(),
                "payload": body if fields["WARC-Type"] == "response" else None}

    def read(batches):
        fs, root = storage.open_fs(uri)
        for batch in batches:
            for name in batch["name"].to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in members(stream):
                        fields, block = parse(data)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(row(fields, block))
                        held += len(block) if content else 0
                        if len(rows) == 2000 or held > 16 << 20:
                            yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=types)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=types)

    files = spark.read.parquet(f"{path}/manifest").select("name")
    found = files.repartition(storage.shards(spark), "name").mapInArrow(read, schema)
    return found.withColumns({c: F.col(c).cast(kind) for c in ("id", "refers_to")})
