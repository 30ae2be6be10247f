"""Best-fit packing of documents into sequences of a fixed number of tokens.

Only how many pieces there are of each length decides the packing, so the plan is made from that
histogram (at most ``capacity`` counts, whatever the input's size): pieces above a third of the
capacity are matched greedily, at most two to a sequence, each with the longest partner that still
fits; shorter ones, longest first, go to the smallest gap that holds them. The plan lists for each
length which ranks go to which sequences; pieces get their rank within their length from counts of
hash-dealt groups, so no length, however common, meets in one task.

Defined results: null text is the empty text (one piece with the end id); repeated rows are packed
one by one; documents longer than the capacity are cut into full pieces, the first being the rest;
an empty table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm import storage
from cartwheel.llm.tokens import TABLE_BYTES, encoder

BATCH = 2048


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
           text_col: str = "text", content: str = "ids", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length`` and ``ids`` (array), or ``ids_crc32`` of the
    ids as little-endian unsigned 32-bit integers by ``content='crc32'``. ``table_bytes`` bounds a worker's table of
    encoded chunks."""
    last, kind = ("ids", "array<int>") if content == "ids" else ("ids_crc32", "bigint")
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        enc = encoder(tokenizer_path, table_bytes)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                rows, numbers, starts, lengths, out = [], [], [], [], []
                for row, ids in enumerate(enc.encode_many(batch["text"].to_pylist())):
                    ids = np.append(np.frombuffer(ids, enc.dtype).astype("<u4"), np.uint32(end_id))
                    begin, end, number = 0, (len(ids) - 1) % capacity + 1, 0
                    while begin < len(ids):
                        part = ids[begin:end]
                        rows.append(row)
                        numbers.append(number)
                        starts.append(begin)
                        lengths.append(len(part))
                        out.append(part.view("<i4") if content == "ids" else zlib.crc32(part.tobytes()))
                        begin, end, number = end, end + capacity, number + 1
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].take(pa.array(rows, pa.int32())), pa.array(numbers, pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(out, pa.list_(pa.int32()) if content == "ids" else pa.int64())],
                    ["doc_id", "piece", "start", "length", last])
            storage.release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, f"doc_id {id_type}, piece int, start bigint, length bigint, {last} {kind}")


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths in them, how many such sequences); few kinds, whatever the counts are."""
    left = {n: c for n, c in histogram.items() if c > 0}
    gaps: dict[int, list] = defaultdict(list)  # by gap: [lengths, count]
    open_gaps: list[int] = []
    full: list[tuple[tuple[int, ...], int]] = []

    def put(lengths: tuple[int, ...], count: int) -> None:
        gap = capacity - sum(lengths)
        if gap == 0:
            full.append((lengths, count))
        else:
            if not gaps[gap]:
                insort(open_gaps, gap)
            gaps[gap].append([lengths, count])

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        at = bisect_left(large, capacity - longest + 1) - 1
        if at < 0:
            put((longest,), left[longest])
            spent = [longest]
        else:
            partner = large[at]
            pairs = left[longest] // 2 if partner == longest else min(left[longest], left[partner])
            if pairs:
                put((longest, partner), pairs)
            left[longest] -= pairs
            left[partner] -= pairs
            if partner == longest and left[longest]:  # the odd one takes the next shorter partner, if any
                left[longest] = 0
                if at:
                    left[large[at - 1]] -= 1
                    put((longest, large[at - 1]), 1)
                else:
                    put((longest,), 1)
            spent = [n for n in {longest, partner, large[max(at - 1, 0)]} if left[n] == 0]
        for n in spent:
            large.remove(n)
            left[n] = 0
    for size in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[size]
        while count:
            at = bisect_left(open_gaps, size)
            if at == len(open_gaps):
                each = capacity // size
                put((size,) * min(each, count), max(1, count // each))
                count = count % each if count >= each else 0
                continue
            gap = open_gaps[at]
            kind = gaps[gap][-1]
            # as many to each sequence as fit, before the next sequence
            each = min(gap // size, count)
            used = min(kind[1], count // each)
            put(kind[0] + (size,) * each, used)
            kind[1] -= used
            count -= used * each
            if not kind[1]:
                gaps[gap].remove(kind)
            if not gaps[gap] and gap in open_gaps:
                open_gaps.remove(gap)
    return full + [(k[0], k[1]) for kinds in gaps.values() for k in kinds]


def placements(kinds: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end of ranks, sequence of the first rank, offset in the sequence)."""
    ranks: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for lengths, count in kinds:
        offset = 0
        for n in lengths:
            out.append((n, ranks[n], ranks[n] + count, sequence, offset))
            ranks[n] += count
            offset += n
        sequence += count
    return out


def pack(parts: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of :func:`pieces`."""
    spark = parts.sparkSession
    kept = storage.written(parts, "pieces")
    groups = storage.shards(spark)
    dealt = kept.withColumn("dealt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    counts = dealt.groupBy("length", "dealt").agg(F.count("*").alias("n"))
    counts = storage.written(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(n > capacity for n in histogram):
        raise ValueError("a piece is longer than the capacity")
    rows = placements(plan(histogram, capacity))
    table = spark.createDataFrame(rows, "p_length bigint, first bigint, last bigint, p_sequence bigint, offset bigint")
    before = Window.partitionBy("length").orderBy("dealt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "dealt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    tie = "ids_crc32" if "ids_crc32" in parts.columns else "ids"
    within = Window.partitionBy("length", "dealt").orderBy("doc_id", "piece", "start", tie)
    ranked = (dealt.withColumn("nth", F.row_number().over(within) - 1).join(offsets, ["length", "dealt"])
              .withColumn("rank", F.col("base") + F.col("nth")))
    # the plan has at most a few thousand rows, bounded by the capacity
    found = ranked.join(F.broadcast(table), (F.col("length") == F.col("p_length"))
                        & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    return found.select(*parts.columns, (F.col("p_sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
                        "offset")
