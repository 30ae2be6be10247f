"""Line deduplication by log templates, in DataFrame functions only.

Lines walk a tree of fixed depth: number of words, then the first ``depth`` words, words with a digit standing
as ``<*>``. In a leaf, a word stays part of its line's template if enough other lines of the leaf have the same word
in the same place; other words are variable fields and become ``<*>`` too. Enough is more than a tenth of the leaf's
distinct lines; where that leaves a share of fixed words under ``fixed_share`` (a leaf of many templates), more than a hundredth, a
thousandth and so on, down to one other line. A field of many values thus stays variable however large its leaf grows.
A template under ``fixed_share`` even then is too general: the line then is its own template, with its digits where
they are in too many of its words. Lines
whose template occurs in several documents are dropped, but for those of the first document
(the least id), so every recurring passage stays once.

Only leaves that several documents reach are looked into, and only their distinct lines word by word.
Templates are counted by (template, document) before they meet, so a line in a third of all documents
sends each task's partial counts only.

Defined results: null text stays null; blank lines are never dropped; rows with equal id and
text are one document, rows with equal ids and other texts are several; null ids come first; ties between them go to the
text's hash; an empty table stays empty; other columns are kept and their names may be any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.once import once
from cartwheel.llm import storage

VARIABLE = "<*>"
#: A key set of at most so many 64-bit rows may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1 << 20
_WITH_DIGIT = r"(?<![^ \t\x0B\f\r])[^ \t\x0B\f\r0-9]*+[0-9][^ \t\x0B\f\r]*+"


def _spaced(line: Column) -> Column:
    return F.when(line.rlike(r"[\t\x0B\f\r]"), F.translate(line, "\t\x0b\f\r", "    ")).otherwise(line)


def words_of(line: Column) -> Column:
    """A line's words, those with a digit as the variable mark. Rare cases alone pay for a pattern."""
    spaced = _spaced(line)
    masked = F.when(spaced.rlike("[0-9]"), F.regexp_replace(spaced, _WITH_DIGIT, VARIABLE)).otherwise(spaced)
    return F.array_remove(F.split(masked, " "), "")


def _raw(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"),
                       F.posexplode(F.split(text, "\n", -1)).alias("place", "raw"))


def _lines(docs: DataFrame, id_col: str, text_col: str, depth: int, fixed_share: float) -> DataFrame:
    """``id, mark, place, size, leaf, line, code, own`` of every line with words; ``code`` is the raw line's hash, ``own``
    that of its words as they are where too many have a digit for the masked line to be a template, else null."""
    found = _raw(docs, id_col, text_col).withColumn("words", words_of(F.col("raw"))).where(F.size("words") > 0)
    bare = F.size(F.array_remove("words", VARIABLE)) / F.size("words") < fixed_share
    return found.select(
        "id", "mark", "place", F.size("words").alias("size"),
        F.xxhash64(F.size("words"), F.slice("words", 1, depth)).alias("leaf"), F.xxhash64("words").alias("line"),
        F.xxhash64("raw").alias("code"),
        F.when(bare, F.xxhash64(F.array_remove(F.split(_spaced(F.col("raw")), " "), ""))).alias("own"))


def _one_of(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Rows whose key is in ``keys``; a written table of distinct keys, sent whole only if it is known to be small."""
    few = keys.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(keys) if few else keys, name, "left_semi")


def templates(lines: DataFrame, fixed_share: float) -> DataFrame:
    """``leaf, line, template`` of distinct lines (``leaf, line, words``) whose template is fixed enough."""
    placed = lines.select("leaf", "line", F.posexplode("words").alias("at", "word"))
    shared = placed.groupBy("leaf", "at", F.xxhash64("word").alias("code")).agg(F.count("*").alias("n")).where("n > 1")
    kept = placed.withColumn("code", F.xxhash64("word")).join(shared, ["leaf", "at", "code"], "left")
    # all lines of a leaf have its first words, so a line's largest count is the number of the leaf's lines
    whole = kept.groupBy("leaf", "line").agg(
        F.sort_array(F.collect_list(F.struct("at", "code", F.when(F.col("word") != VARIABLE, F.col("n")).alias("n")))).alias("cells"),
        F.max("n").alias("most"))
    size = F.size("cells")
    need = F.ceil(size * fixed_share).cast("int")
    need = F.when((need - 1) / size >= fixed_share, need - 1).otherwise(need)  # the product may be rounded up
    least = F.get(F.sort_array("cells.n", asc=False), F.greatest(need, F.lit(1)) - 1)
    bound = F.col("most") / F.pow(F.lit(10.0), F.floor(F.log10(F.col("most") / least)) + 1)
    bounded = whole.select("leaf", "line", "cells", once(bound).alias("bound")).where("bound is not null")
    spelled = F.transform("cells", lambda cell: F.when(cell["n"] > F.col("bound"), cell["code"]).otherwise(F.lit(0)))
    return bounded.select("leaf", "line", F.xxhash64(spelled).alias("template"))


def recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 3, fixed_share: float = 0.7,
              min_docs: int = 2, short: int = 8, short_docs: int = 10) -> DataFrame:
    """``id, mark, drop, lines``: for each document with lines to drop their places.

    Templates of at least ``short`` words recur in ``min_docs`` documents, shorter ones, which also meet by
    chance, in ``short_docs``.
    """
    light = storage.written(_lines(docs, id_col, text_col, depth, fixed_share), "lines")
    document = F.struct("id", "mark")
    met = light.groupBy("leaf").agg(F.min(document) != F.max(document), F.min("line") != F.max("line"))
    met = storage.written(met.toDF("leaf", "docs", "lines").where("docs").select("leaf", "lines"), "leaves")
    # of each distinct line of a leaf with several, one raw text is fetched
    several = light.join(met.where("lines").select("leaf"), "leaf", "left_semi").groupBy("leaf", "line").agg(
        F.min("code").alias("code"))
    several = storage.written(several, "lines-to-compare")
    codes = storage.written(several.select("code").distinct(), "codes")
    texts = _one_of(_raw(docs, id_col, text_col).select("raw").withColumn("code", F.xxhash64("raw")), codes, "code")
    texts = texts.groupBy("code").agg(F.min("raw").alias("raw"))
    found = storage.written(templates(several.join(texts, "code").select("leaf", "line", words_of(F.col("raw")).alias("words")),
                                      fixed_share), "templates")
    named = (light.join(met.select("leaf"), "leaf", "left_semi").join(found, ["leaf", "line"], "left")
             .withColumn("general", F.col("template").isNotNull())
             .withColumn("template", F.coalesce("template", "own", "line")))
    named = storage.written(named.select("id", "mark", "place", "size", "leaf", "general", "template"), "named-lines")
    key = ["leaf", "general", "template"]
    by_doc = named.groupBy(*key, "size", "id", "mark").agg(F.lit(1).alias("one"))
    often = (by_doc.groupBy(*key, "size").agg(F.count("*").alias("docs"), F.min(document).alias("first"))
             .where(F.col("docs") >= F.when(F.col("size") >= short, min_docs).otherwise(short_docs)))
    often = storage.written(often.select(*key, F.col("first.id").alias("first_id"), F.col("first.mark").alias("first_mark")),
                            "recurring")
    gone = named.join(often, key).where(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark"))))
    return gone.groupBy("id", "mark").agg(F.collect_set("place").alias("drop"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count: str | None = None, **options) -> DataFrame:
    """``docs`` with recurring lines dropped from their texts; ``count`` names a column for how many."""
    gone = recurring(docs, id_col, text_col, **options)
    text = F.col(text_col).cast("string")
    names = docs.columns
    fresh = lambda name: name if name not in names else fresh(name + "_")
    key, mark, drop = fresh("line_id"), fresh("line_mark"), fresh("line_drop")
    gone = gone.select(F.col("id").alias(key), F.col("mark").alias(mark), F.col("drop").alias(drop))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone[key]) & (F.xxhash64(text) == gone[mark]), "left")
    rest = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, at: ~F.array_contains(drop, at)), "\n")
    kept = F.when(F.col(drop).isNull(), F.col(text_col)).otherwise(rest)
    out = [kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in names]
    if count:
        out.append(F.coalesce(F.size(drop), F.lit(0)).cast("bigint").alias(count))
    return joined.select(*out)
