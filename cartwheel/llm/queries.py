"""Registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import (decontaminate, html_extract, jaccard_join, line_dedup, packing, prefix_trie, quality_rules, simhash, storage, token_store, topk,
                           toxicity, warc, whitening)
from cartwheel.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    storage.ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, _table(spark, sf_dir, "labels"), usable=fold(4) != 2)
    return quality_rules.score(docs, model).select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs, count="n_dropped")


OP2_SQL = r"""
WITH docs AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents),
raw AS (SELECT doc_id, r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
        FROM docs),
split AS (
    SELECT doc_id, r, place, list_filter(regexp_split_to_array(
        regexp_replace(line, '[^ \t\x0B\f\r]*[0-9][^ \t\x0B\f\r]*', '<*>', 'g'), '[ \t\x0B\f\r]+'), lambda w: w <> '') AS words,
        array_to_string(list_filter(regexp_split_to_array(line, '[ \t\x0B\f\r]+'), lambda w: w <> ''), ' ') AS digits
    FROM raw),
lines AS (
    SELECT doc_id, r, place, words, len(words) AS size, array_to_string(words[1:3], ' ') AS head,
           array_to_string(words, ' ') AS line,
           CASE WHEN len(list_filter(words, lambda w: w <> '<*>')) / len(words) < 0.7::DOUBLE THEN digits END AS own
    FROM split WHERE len(words) > 0),
leaves AS (SELECT size, head FROM lines GROUP BY ALL HAVING count(DISTINCT doc_id) > 1),
few AS (SELECT l.* FROM lines l JOIN leaves USING (size, head)),
distinct_lines AS (SELECT size, head, line, any_value(words) AS words FROM few GROUP BY size, head, line),
placed AS (SELECT size, head, line, unnest(words) AS word, generate_subscripts(words, 1) AS spot FROM distinct_lines),
shared AS (SELECT size, head, spot, word, count(*) AS n FROM placed GROUP BY ALL HAVING count(*) > 1),
spelled AS (
    SELECT p.*, s.n, CASE WHEN p.word <> '<*>' THEN s.n END AS alike
    FROM placed p LEFT JOIN shared s ON p.size = s.size AND p.head = s.head AND p.spot = s.spot AND p.word = s.word),
counted AS (
    SELECT size, head, line, max(n) AS most, list_sort(list(alike) FILTER (alike IS NOT NULL), 'DESC') AS counts,
           ceil(size * 0.7::DOUBLE) AS up, CASE WHEN (up - 1) / size >= 0.7::DOUBLE THEN up - 1 ELSE up END AS need
    FROM spelled GROUP BY size, head, line),
least AS (SELECT *, counts[greatest(need, 1)::BIGINT] AS count FROM counted),
bounded AS (
    SELECT size, head, line, most / pow(10::DOUBLE, floor(log10(most / count)) + 1) AS bound FROM least WHERE count IS NOT NULL),
whole AS (
    SELECT s.size, s.head, s.line, string_agg(CASE WHEN alike > bound THEN word ELSE '<*>' END, ' ' ORDER BY spot) AS template
    FROM spelled s JOIN bounded b ON s.size = b.size AND s.head = b.head AND s.line = b.line
    GROUP BY s.size, s.head, s.line),
named AS (
    SELECT f.doc_id, f.r, f.place, f.size, f.head, w.template IS NOT NULL AS general,
           coalesce(w.template, f.own, f.line) AS template
    FROM few f LEFT JOIN whole w USING (size, head, line)),
often AS (
    SELECT size, head, general, template, min(doc_id) AS first FROM named GROUP BY ALL
    HAVING count(DISTINCT doc_id) >= CASE WHEN size >= 8 THEN 2 ELSE 10 END),
gone AS (
    SELECT n.r, n.place FROM named n JOIN often o USING (size, head, general, template) WHERE n.doc_id <> o.first),
rest AS (
    SELECT raw.r, string_agg(raw.line, chr(10) ORDER BY raw.place) FILTER (WHERE gone.r IS NULL) AS text,
           count(gone.r) AS n_dropped
    FROM raw LEFT JOIN gone ON raw.r = gone.r AND raw.place = gone.place GROUP BY raw.r)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(x.text, '') END AS text,
       coalesce(x.n_dropped, 0) AS n_dropped
FROM docs d LEFT JOIN rest x ON d.r = x.r
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, min_revisit=1000)
    return warc.read_archives(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH bytes AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages),
known AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 1000)
              END AS response
    FROM bytes)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response <> page_id OR (page_id IS NULL AND response IS NOT NULL) THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN response <> page_id OR (page_id IS NULL AND response IS NOT NULL) THEN response END AS refers_to
FROM known
"""


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_store(_table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=0)
    return token_store.read_store(spark, path, content="crc32")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(_table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end_id=2, content="crc32")
    return packing.pack(parts, capacity=1024)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


OP7_SQL = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.extract(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.fit(docs, _table(spark, sf_dir, "labels"), usable=fold(3) != 1)
    return toxicity.score(docs, net).select(
        "doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=16, scale=64, shift=1_000_000).withColumnRenamed("id", "vec_id")


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_sets(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


OP13_SQL = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS t
    FROM turns GROUP BY conv_id),
headed AS (
    SELECT conv_id, t, (xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
            lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 6)::BIGINT AS h
    FROM own),
rebuilt AS (
    SELECT c.conv_id, coalesce(b.t[1:c.h], []) || c.t[c.h + 1:] AS t
    FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
every AS (SELECT conv_id, unnest(range(0, len(t) + 1)) AS depth, t FROM rebuilt),
nodes AS (
    SELECT depth, t[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
           string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(t) = depth) AS ends
    FROM every GROUP BY 1, 2),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children, (n_convs - 1) * coalesce(length(n.path[depth].t), 0) AS saved
    FROM nodes n LEFT JOIN children c ON c.path = n.path),
below AS (SELECT path[1:up] AS path, saved, n_children FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted)),
sums AS (SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved FROM below GROUP BY 1)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(c.ends, '')) AS ends_sha256
FROM counted c JOIN sums s ON s.path = c.path LEFT JOIN nodes p ON c.depth > 0 AND p.path = c.path[1:c.depth - 1]
"""


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op3_simhash, op4_warc, op5_token_store, op6_packing, op7_topk, op8_html_extract, op9_decontaminate, op10_toxicity, op11_whitening, op12_jaccard_join, op13_prefix_trie)}


def all_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op4_warc": OP4_SQL, "op7_topk": OP7_SQL, "op13_prefix_trie": OP13_SQL}
