"""Similarity join on word n-grams with a token-group matrix.

Texts are sets of n-gram hashes; equal sets are one class. The join then runs in these steps:

1. A class that has too many tokens that no other class has is linked with nothing and leaves. Such tokens are counted
   by grouping (a token's copies are combined before the shuffle), first among the tokens of a quarter of all hash
   values, which is a lower bound and so drops no partner, then among all tokens of what is left.
2. Among the rest each class is compared with the centre of two buckets (its least tokens by two hashes); the centre is the
   bucket's class of the commonest tokens. What is linked so is one group already; the others are grouped by bucket.
   Groups are cut into blocks of at most about ``BLOCK_TOKENS`` tokens, so no group is held in one place.
3. The token-group matrix has a row for each token of the rare prefix of a block's members. A class meets the
   blocks that hold a token of its own rare prefix: without one no member can be similar enough. Blocks linked to
   the class already, and pairs met from the other side, are left out.
4. In a task, queries of a block are gathered up to the same bound. A query's overlap with the union of the block's tokens
   bounds its overlap with every member; only blocks that reach the threshold are opened, and there all members are
   counted exactly. Of the links found only those that connect something new are returned.

Links and groups give components by the star rounds of :mod:`simhash`.

Defined results: null, empty and wordless texts have an empty set and are linked with nothing; texts of fewer words
than n are one token; rows that share an id are one document, and link what its texts link to; rows with a null id have no
component; an empty table gives no rows; other columns are ignored whatever their names. Tokens are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm import storage
from cartwheel.llm.simhash import LOWER, components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BLOCK_TOKENS = 1 << 16
#: The number of tokens looked up in a broadcast table at most: those with at least this share of all rows.
HOT = 1 << 18
#: One in so many hash values belongs to the tokens of the first count.
SOME = 4


def tokens(text: str | None, n: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    if not words:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    if len(words) <= n:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(n))))
    return np.unique(np.array([digest(g) for g in grams], np.uint64).view(np.int64))


def _sets(docs: DataFrame, n: int, every: int) -> DataFrame:
    """``id, size, code, tokens`` of each row; of the tokens those whose hash is a multiple of ``every``."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        storage.let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                found = [tokens(t, n) for t in part["text"].to_pylist()]
                codes = [hashlib.blake2b(f.tobytes(), digest_size=16).digest() if len(f) else None for f in found]
                some = found if every == 1 else [f[f % every == 0] for f in found]
                ends = np.cumsum([0] + [len(f) for f in some])
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array([len(f) for f in found], pa.int64()), pa.array(codes, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(some)))],
                    ["id", "size", "code", "tokens"])
            storage.release()

    return docs.mapInArrow(run, f"id {id_type}, size bigint, code binary, tokens array<bigint>")


def _may_miss(size: Column, percent: int) -> Column:
    """How many tokens of a set of ``size`` a partner may lack."""
    return size - F.floor((size * percent + 99) / 100).cast("bigint")


def _without_loners(sets: DataFrame, by: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Keys ``by`` (with ``size``) that may have a partner, and each token's ``met`` sets."""
    met = storage.written(sets.select(by, F.explode("tokens").alias("token")).groupBy("token").agg(
        F.min(by).alias("lo"), F.max(by).alias("hi"), F.count("*").alias("met")), "token-sets")
    alone = met.where("lo = hi").groupBy(F.col("lo").alias(by)).agg(F.count("*").alias("alone"))
    known = sets.select(by, "size").distinct()
    left = known.join(alone, by, "left").where(F.coalesce("alone", F.lit(0)) <= _may_miss(F.col("size"), percent))
    return storage.written(left.select(by), "may-have-partners"), met


def _compare(percent: int):
    """Links between the queries and the members of a row, of a spanning set each."""

    def run(batches):
        for batch in batches:
            a, b = [], []
            for row in batch.to_pylist():
                for x, y in compare(row["members"], row["queries"], percent):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def compare(members: list[dict], queries: list[dict], percent: int) -> list[tuple[int, int]]:
    """Links (query, member) that join sets that no earlier link and no common ``root`` joins."""
    held = [np.asarray(m["tokens"], np.int64) for m in members]
    sizes = np.array([len(h) for h in held])
    union, place = np.unique(np.concatenate(held), return_inverse=True)
    order = np.argsort(place, kind="stable")
    owner = np.repeat(np.arange(len(held)), sizes)[order]
    starts = np.append(0, np.cumsum(np.bincount(place, minlength=len(union))))
    up: dict = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    links = []
    for q in queries:
        own = np.asarray(q["tokens"], np.int64)
        at = np.searchsorted(union, own)
        at = at[union[np.minimum(at, len(union) - 1)] == own]
        if 100 * len(at) < percent * len(own):  # the bound: no member shares more
            continue
        counts = starts[at + 1] - starts[at]
        shifts = np.repeat(starts[at] - np.append(0, np.cumsum(counts)[:-1]), counts)
        shared = np.bincount(owner[shifts + np.arange(counts.sum())], minlength=len(held))
        for i in np.flatnonzero(100 * shared >= percent * (sizes + len(own) - shared)).tolist():
            x, y = root(q["root"]), root(members[i]["root"])
            if x != y:
                up[x] = y
                links.append((q["number"], members[i]["number"]))
    return links


def _blocks(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with a ``block`` of their group: as many blocks as its tokens need."""
    total = rows.groupBy(*key).agg((F.floor(F.sum("size") / BLOCK_TOKENS) + 1).cast("bigint").alias("blocks"))
    dealt = F.pmod(F.xxhash64("number", F.lit(5)), F.col("blocks"))
    return rows.join(total, key).withColumn("block", dealt).drop("blocks")


def _gathered(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.collect_list(F.struct("number", "root", "tokens")).alias(name))


def _common(sets: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """``number, size, prefix, key0, key1, common``: the rare tokens, two least tokens and mean commonness of each set."""
    rows = sets.select("number", "size", F.explode("tokens").alias("token"))
    total = met.agg(F.sum("met")).first()[0] or 0
    often = met.where(F.col("met") * HOT >= total).select("token", "met")
    seldom = met.where(F.col("met") * HOT < total).select("token", "met")
    # by their share there are at most HOT of the first kind; the others are met too seldom to burden a task
    known = rows.join(F.broadcast(often), "token", "left").withColumnRenamed("met", "m")
    hot, cool = known.where("m IS NOT NULL"), known.where("m IS NULL").drop("m")
    every = hot.withColumnRenamed("m", "met").unionByName(cool.join(seldom, "token"))
    least = [F.min_by("token", F.when(F.col("met") > 1, F.xxhash64("token", F.lit(i)))).alias(f"key{i}") for i in (0, 1)]
    found = every.groupBy("number", "size").agg(
        F.sort_array(F.collect_list(F.struct("met", "token"))).alias("t"), *least, F.avg(F.log("met")).alias("common"))
    prefix = F.slice("t", F.lit(1), (_may_miss(F.col("size"), percent) + 1).cast("int"))
    return found.select("number", "size", "common", "key0", "key1", prefix["token"].alias("prefix"))


def star_links(sets: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Links of sets to the centres of their two buckets."""
    keyed = marks.select("number", "size", "common", F.posexplode(F.array("key0", "key1")).alias("k", "key"))
    centres = keyed.groupBy("k", "key").agg(F.max_by("number", F.struct("common", "number")).alias("centre"))
    pairs = keyed.join(centres, ["k", "key"]).where(F.col("number") != F.col("centre")).select(
        "centre", "number", "size").distinct()
    pairs = storage.written(_blocks(pairs, ["centre"]), "star-pairs")
    carried = sets.select("number", "tokens", F.col("number").alias("root"))
    members = _gathered(pairs.join(carried, "number"), ["centre", "block"], "members")
    asked = pairs.select("centre", "block").distinct().join(carried, F.col("centre") == F.col("number"))
    queries = asked.select("centre", "block", F.array(F.struct("number", "root", "tokens")).alias("queries"))
    return members.join(queries, ["centre", "block"]).select("members", "queries").mapInArrow(
        _compare(percent), "a bigint, b bigint")


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def links(sets: DataFrame, met: DataFrame, percent: int = 85) -> DataFrame:
    """Links ``a, b`` of ``sets`` (``number, size, tokens``) that connect all that are similar enough."""
    marks = storage.written(_common(sets, met, percent), "set-marks")
    stars = storage.written(_ordered(star_links(sets, marks, percent)), "star-links")
    roots = components(stars)
    linked = roots.select(F.col("node").alias("number"), "root").unionByName(
        roots.select(F.col("root").alias("number"), "root").distinct())
    grouped = marks.join(linked, "number", "left").withColumn("joined", F.col("root").isNotNull()).withColumn(
        "group", F.coalesce("root", "key0", "number")).withColumn("root", F.coalesce("root", "number"))
    place = ["joined", "group", "block"]
    dealt = storage.written(_blocks(grouped.select("number", "size", "root", "joined", "group", "prefix"), ["joined", "group"]),
                            "token-groups")
    # the matrix: tokens of the rare prefixes by block
    spread = dealt.select("number", "size", "root", *place, F.explode("prefix").alias("token"))
    matrix = spread.groupBy("token", *place).agg(F.min("size").alias("least"), F.max("size").alias("most"))
    matrix = matrix.select("token", F.struct(*place).alias("opened"), "least", "most")
    fits = (100 * F.least("size", "most") >= percent * F.col("size")) & (100 * F.col("size") >= percent * F.col("least"))
    other = ~(F.col("opened.joined") & (F.col("opened.group") == F.col("root")))
    asked = spread.withColumn("own", F.struct(*place)).join(matrix, "token").where(
        (F.col("opened") <= F.col("own")) & other & fits).select("number", "size", "root", "opened").distinct()
    asked = asked.select("number", "size", "root", *[F.col(f"opened.{c}").alias(c) for c in place])
    chunks = storage.written(_blocks(asked.withColumnRenamed("block", "of"), ["joined", "group", "of"])
                             .withColumnRenamed("block", "chunk").withColumnRenamed("of", "block"), "asked-blocks")
    carried = sets.select("number", "tokens")
    queries = _gathered(chunks.join(carried, "number"), [*place, "chunk"], "queries")
    needed = dealt.join(chunks.select(*place).distinct(), place, "left_semi")
    members = _gathered(needed.select("number", "root", *place).join(carried, "number"), place, "members")
    found = queries.join(members, place).select("members", "queries").mapInArrow(_compare(percent), "a bigint, b bigint")
    return stars.unionByName(_ordered(found))


def similar_sets(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    storage.ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    marked = storage.written(_sets(texts, n, SOME), "gram-sets")
    named = marked.where(F.col("id").isNotNull() & F.col("code").isNotNull())
    classes = storage.written(named.groupBy("code").agg(F.min("id").alias("rep"), F.min("size").alias("size")), "gram-classes")
    left, _ = _without_loners(named.withColumn("short", F.xxhash64("code")), "short", percent)
    chosen = storage.written(classes.join(left, F.xxhash64("code") == F.col("short"), "left_semi").select(
        "code", "rep", F.monotonically_increasing_id().alias("number")), "near-classes")
    again = texts.join(chosen.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    whole = _sets(again, n, 1).join(chosen.withColumnRenamed("rep", "id"), ["id", "code"])
    near = storage.written(whole.groupBy("id", "code").agg(
        *[F.first(c).alias(c) for c in ("number", "size", "tokens")]).select("number", "size", "tokens"), "near-sets")
    still, met = _without_loners(near, "number", percent)
    sets = storage.written(near.join(still, "number", "left_semi"), "similar-sets")
    found = storage.written(links(sets, met, percent), "jaccard-links")
    name = chosen.select("number", "rep")
    edges = (found.join(name.withColumnRenamed("number", "a").withColumnRenamed("rep", "x"), "a")
             .join(name.withColumnRenamed("number", "b").withColumnRenamed("rep", "y"), "b").select("x", "y"))
    # an id met with several sets joins their classes; rare, so found by the id alone
    several = (named.groupBy("id").agg(F.min("code").alias("lo"), F.max("code").alias("hi")).where("lo <> hi").select("id"))
    joined = named.join(several, "id", "left_semi").join(classes, "code").select(F.col("id").alias("x"), F.col("rep").alias("y"))
    edges = edges.unionByName(joined).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).where("a <> b")
    roots = components(storage.written(edges.distinct(), "jaccard-edges"))
    of_class = classes.join(roots, classes["rep"] == roots["node"], "left").select("code", F.coalesce("root", "rep").alias("component"))
    return marked.join(of_class, "code", "left").select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
