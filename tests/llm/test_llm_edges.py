"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartwheel.llm import (decontaminate, html_extract, line_dedup, packing, quality_rules, simhash, token_store, topk,
                           toxicity, warc)
from cartwheel.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars int"
# names that the operators use inside
CLASH = ["id", "bits", "found", "score", "label", "spans", "words", "text_", "row", "tie", "rank", "drop", "mark",
         "line_id", "line_mark", "line_drop", "found_", "score_", "digest", "piece", "key"]
LONG = "alpha beta gamma delta " * 30000


def rows():
    return [(None, None, None, None, None), (None, "a b c d e f g h i j", "en", "s", 19), (1, None, "en", None, None),
            (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (4, "Hello world", "en", "s", 11),
            (4, "Hello world", "en", "s", 11), (4, "another text of the same id", "en", "s", 27),
            (5, "x" * 5000, "en", "s", 5000), (6, LONG, "en", "s", len(LONG)), (7, "Hello world", "en", "s", 11),
            (8, "ü ß 日本 \x00 \x1f idiot", "de", "s", 14)]


@pytest.fixture(params=["plain", "clash", "empty"])
def docs(spark, request):
    df = spark.createDataFrame([] if request.param == "empty" else rows(), DOCS)
    if request.param == "clash":
        for i, name in enumerate(CLASH):
            df = df.withColumn(name, F.lit(i))
    return df


@pytest.fixture(scope="module")
def net():
    good = [[["plain", "words", "only"]], [["more", "plain", "words"]], [["quiet", "words"]]] * 8
    bad = [[["you", "idiot", "words"]], [["an", "idiot", "speaks"]], [["idiot"]]] * 8
    return toxicity.train(good + bad, [0] * 24 + [1] * 24)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def count(docs):
    return 0 if not docs.limit(1).collect() else len(rows())


def test_quality(spark, docs):
    labels = spark.createDataFrame([(2, 0), (4, 1), (None, 1), (5, None), (6, 1), (4, 1)], "doc_id bigint, quality int")
    model = quality_rules.fit(docs, labels)
    out = quality_rules.score(docs, model, "q")
    assert out.columns == [*docs.columns, "q"]
    got = out.select("q").collect()
    assert len(got) == count(docs) and all(0 <= r[0] <= 1 for r in got)


def test_quality_without_labels(spark, docs):
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    out = quality_rules.score(docs, quality_rules.fit(docs, empty), "q").select("q").collect()
    assert all(r[0] == 0.5 for r in out)


def test_line_dedup(docs):
    out = line_dedup.dedup(docs, count="gone")
    assert out.columns == [*docs.columns, "gone"]
    assert by_id(out.drop("gone")) == by_id(docs)  # no line of eight words recurs


def test_simhash(docs):
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == count(docs)
    if out:
        of = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in out}
        assert of[2, "0" * 16] == 1 and of[3, "0" * 16] == 1 and of[1, "0" * 16] == 1
        assert all(c is None for (i, _), c in of.items() if i is None)
        assert {c for (i, _), c in of.items() if i in (4, 7)} == {4}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    if out:
        assert sorted(r[0] for r in kept.where("doc_id is not null").select("doc_id").collect()) == [1, 4, 5, 6, 8]
        assert kept.where("doc_id is null").count() == 2


def test_token_store(spark, docs):
    path = scratch_path(spark, "test-store")
    token_store.write_store(docs, path, TOKENIZER, end_id=0, max_file_bytes=2000)
    got = [tuple(r) for r in token_store.read_store(spark, path).orderBy("start").collect()]
    assert len(got) == count(docs)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    wanted = sorted([(r[0] is not None, r[0] or 0, whole.encode(r[1] or "", add_special_tokens=False).ids + [0])
                     for r in rows()]) if got else []
    assert [r[0] for r in got] == [w[1] if w[0] else None for w in wanted]
    assert sorted((str(r[0]), r[3]) for r in got) == sorted((str(w[1] if w[0] else None), w[2]) for w in wanted)
    at = 0
    for _, start, n, ids in got:
        assert (start, n) == (at, len(ids))
        at += n


def test_packing(docs):
    parts = packing.pieces(docs, TOKENIZER, capacity=64, end_id=2)
    got = packing.pack(parts, capacity=64).collect()
    assert (len({r["doc_id"] for r in got}) == len({r[0] for r in rows()})) or not count(docs)
    assert sum(len(r["ids"]) for r in got) == sum(r["length"] for r in got)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
        assert o + n <= 64 and o2 == (o + n if s == s2 else 0)


def test_decontaminate(spark, docs):
    bench = spark.createDataFrame([("q1", "A b c d e f g h i j"), ("q2", None), (None, "hello, WORLD"), ("q3", "--")],
                                  "item_id string, text string")
    got = {(r["doc_id"], r["n_words"]): r for r in decontaminate.report(docs, bench).collect()}
    if got:
        assert got[None, 10]["n_hit"] == 10 and got[None, 10]["items"] == ["q1"]
        assert got[4, 2]["n_hit"] == 2 and got[1, 0]["n_hit"] == 0
    out = decontaminate.clean(docs, bench)
    assert out.columns == docs.columns
    assert out.count() == max(0, count(docs) - 4)  # one null id, two rows of 4, and 7 are mostly benchmark
    none = spark.createDataFrame([], "item_id string, text string")
    assert by_id(decontaminate.clean(docs, none)) == by_id(docs)


def test_toxicity(docs, net):
    out = toxicity.score(docs, net, "t")
    assert out.columns == [*docs.columns, "t"]
    got = out.select("text", "t").collect()
    assert len(got) == count(docs) and all(0 <= r[1] <= 1 for r in got)
    assert all(r[1] == 0 for r in got if not (r[0] or "").strip())
    assert all(r[1] > 0.7 for r in got if "idiot" in (r[0] or ""))
    kept = toxicity.keep_clean(docs, net)
    assert kept.columns == docs.columns and kept.count() == max(0, count(docs) - 1)
    assert toxicity.keep_clean(docs, None).count() == count(docs)


PAGES = "page_id bigint, url string, html string"


def pages(spark):
    big = "<p>" + "long text " * 300 + "</p>"
    return spark.createDataFrame([
        (None, None, None), (1, "http://a\r\nX: y", ""), (2, None, big), (3, "u", big), (3, "u", big), (None, "v", big),
        (4, "u", "<p>short</p>"), (5, "u", "<p>short</p>"), (6, "u", "<div>" * 3000 + "deep"), (7, "u", "<b><p>a<p>b &amp; c</b")],
        PAGES)


def test_warc(spark):
    for df in (pages(spark), pages(spark).withColumns({"id": F.lit(1), "digest": F.lit("d"), "payload": F.lit(2)}),
               spark.createDataFrame([], PAGES)):
        path = scratch_path(spark, "test-warc")
        warc.write_archives(df, path, max_file_bytes=3000)
        got = [tuple(r) for r in warc.read_archives(spark, path, content=True).collect()]
        assert len(got) == df.count()
        kinds = sorted((str(r[0]), r[2], r[3]) for r in got if r[4] >= 1000 and r[0] != 6)
        if got:
            assert kinds == [("2", "revisit", 3), ("3", "response", None), ("3", "response", None), ("None", "revisit", 3)]
            assert all(r[2] == "response" for r in got if r[4] < 1000)
            assert {r[1] for r in got if r[0] == 1} == {"http://a%0D%0AX:%20y"}
            text = sorted(r[6].decode() for r in got if r[2] == "response")
            assert "<div>" * 3000 + "deep" in text


def test_html(spark):
    for df in (pages(spark), pages(spark).withColumn("text_", F.lit(1)), spark.createDataFrame([], PAGES)):
        got = html_extract.extract(df).collect()
        assert len(got) == df.count() and all(r["text"] is not None for r in got)
        assert all(r["text"] == "" for r in got if not r["html"])


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (None, [9.0, 9.0]), (8, [1.0, 2.0, 3.0]), (10, [1.0, 2.0, 4.0]), (9, [-1.0, 0.5])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>").withColumn("id", F.lit(7)).withColumn("v", F.lit(8))
    got = sorted(tuple(r) for r in topk.nearest(df, F.col("vec_id") % 10 == 0, k=2).collect())
    assert got == [(0, 1, 1, 327680), (0, 2, 2, 327680), (10, 1, 8, 65536 * 17)]
    assert topk.nearest(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.nearest(df.where("vec_id = 9"), F.col("vec_id") % 10 == 0).count() == 0


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame([(4, 0), (8, 1), (None, 1), (6, None)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such passage")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, left, str(tmp_path)).write.parquet(path)
        left = spark.read.parquet(path)
        assert left.columns == docs.columns and left.dtypes == docs.dtypes
    packed = corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path))
    assert packed.where("piece = 0").count() == left.count()
