"""SimHash near-duplicates: fingerprints, pigeonhole block join, Hamming check, groups.

Fingerprints are cut into ``max_bits + 2`` blocks; two that differ in at most ``max_bits`` bits
share at least two blocks, so every pair of blocks is a join key and the bit distance is checked
after the join. Only distinct fingerprints are joined, each standing for its class of documents. A key
shared by more than ``key_rows`` fingerprints is not joined pairwise: there every fingerprint
lists itself and its neighbours at up to ``max_bits / 2`` flipped bits outside the key; two are within
``max_bits`` bits exactly if they list a common neighbour, so linking all that list it to the least of them
is the same relation without pairs, and the work stays in proportion to the rows.

Defined results: null and empty texts have fingerprint zero and are linked like any other; texts of
fewer words than a shingle are one shingle; rows with a null id form no group (null component);
rows that share an id are one document; an empty table gives an empty result; other columns are
ignored whatever their names.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm import storage

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BLOCK = 1 << 16  # shingles hashed at a time


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits; a bit is set if it is set in over half the shingle hashes (XXH64, seed 42)."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    if not words:
        return 0
    total, digest = max(1, len(words) - shingle + 1), xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, total, BLOCK):
        part = words[at:at + BLOCK + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle))) if len(part) >= shingle else [part]
        hashes = np.array([digest(b" ".join(g), 42) for g in grams], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, bits``: the fingerprint as a signed 64-bit number."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        storage.let_go()
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), shingle) for t in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(bits.view(np.int64))], ["doc_id", "bits"])
            storage.release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, bits bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def key_masks(max_bits: int) -> list[int]:
    """Masks of all pairs of the blocks that 64 bits are cut into."""
    n = max_bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def links(classes: DataFrame, max_bits: int = 2, key_rows: int = 64) -> DataFrame:
    """``a, b`` (a > b): representatives whose fingerprints are linked; of ``classes`` (bits, rep)."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    masks = key_masks(max_bits)
    keyed = classes.select("bits", "rep", F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col("bits").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)])).alias("x")).select("bits", "rep", "x.k", "x.key")
    hot = storage.written(keyed.groupBy("k", "key").count().where(F.col("count") > key_rows).select("k", "key"),
                          "hot-keys")
    cool = keyed.join(hot, ["k", "key"], "left_anti")
    left = cool.select("k", "key", F.col("bits").alias("x"), F.col("rep").alias("a"))
    right = cool.select("k", "key", F.col("bits").alias("y"), F.col("rep").alias("b"))
    near = (left.join(right, ["k", "key"]).where(F.col("x") < F.col("y"))
            .where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits).select("a", "b"))
    outside = F.array(*[F.array(*[F.lit(_signed(f)) for f in flips(m, max_bits // 2)]) for m in masks])
    middle = (keyed.join(hot, ["k", "key"], "left_semi")
              .withColumn("flip", F.explode(F.element_at(outside, F.col("k") + 1)))
              .select("k", "rep", F.col("bits").bitwiseXOR(F.col("flip")).alias("middle")))
    least = middle.groupBy("k", "middle").agg(F.min("rep").alias("b"))
    stars = middle.join(least, ["k", "middle"]).select(F.col("rep").alias("a"), "b")
    both = near.unionByName(stars).where(F.col("a") != F.col("b"))
    return both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def flips(mask: int, most: int) -> list[int]:
    """Patterns of at most ``most`` bits outside ``mask``."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [sum(1 << i for i in c) for n in range(most + 1) for c in combinations(free, n)]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the least node reachable) of every node of ``edges`` (a > b) but the roots themselves.

    Large-star and small-star rounds; each round's edges are a written table, and their number never grows
    beyond the first's, so no neighbourhood is gathered in one place.
    """
    now, seen = edges, None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where(F.col("b") != F.col("m"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = storage.written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    marked = storage.written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = storage.written(marked.where(F.col("doc_id").isNotNull()).groupBy("bits")
                              .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("other")), "classes")
    edges = links(classes, max_bits)
    # an id met with several fingerprints joins their classes; rare, so found by the id alone
    several = (marked.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
               .agg(F.min("bits").alias("lo"), F.max("bits").alias("hi")).where(F.col("lo") != F.col("hi")))
    joined = (marked.join(several.select("doc_id"), "doc_id", "left_semi").join(classes, "bits")
              .where(F.col("doc_id") != F.col("rep")).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    edges = storage.written(edges.unionByName(joined).distinct(), "links")
    roots = components(edges)
    named = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        "bits", F.coalesce("root", "rep").alias("component"))
    return marked.join(named, "bits", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, one document of each group: that with the least id; of its rows, one.

    Rows with a null id form no group and stay.
    """
    found = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    first = found.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("rows"))
    first = storage.written(first, "first")
    once, more = first.where("rows = 1"), first.where("rows > 1")
    same = lambda ids: docs[id_col] == ids["doc_id"]
    return (docs.where(F.col(id_col).isNull()).unionAll(docs.join(once, same(once), "left_semi"))
            .unionAll(docs.join(more, same(more), "left_semi").dropDuplicates([id_col])))
