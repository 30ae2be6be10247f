"""The training-data operators against brute force, exact round trips, held-out accuracy and SQL."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cartwheel.llm import (decontaminate, html_extract, line_dedup, packing, quality_rules, queries, simhash, storage, token_store,
                           topk, toxicity, warc)
from cartwheel.llm.tokens import ChunkEncoder
from cartwheel.session import scratch_path

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
here = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="test tables not present")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module")
def ids(spark):
    whole = Tokenizer.from_file(TOKENIZER)
    return {r["doc_id"]: whole.encode(r["text"] or "", add_special_tokens=False).ids for r in table(spark, "documents").collect()}


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


@here
@pytest.mark.parametrize("name", ["op2_line_dedup", "op4_warc", "op7_topk"])
def test_sql(spark, name):
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from oracle_check import compare

    assert compare(spark, SF, [name], verbose=False)[name][0] == "OK"


def test_chunks_equal_the_library():
    enc, rng = ChunkEncoder(TOKENIZER, table_bytes=100_000), random.Random(1)
    odd = ["", " ", "a  b", "a \n b", "it's  don't a's.\n's", "x²ª 12ab_c", "\x1c a\x1d b", "日本語 テスト。 a", "<|endoftext|> x", "tail "]
    odd += ["".join(rng.choice("ab 'sé\n\t.1²  _llve日\x1c") for _ in range(rng.randint(1, 30))) for _ in range(5000)]
    whole = enc.tokenizer.encode_batch(odd, add_special_tokens=False)
    assert [list(np.frombuffer(b, enc.dtype)) for b in enc.encode_many(odd)] == [w.ids for w in whole]


def test_texts_with_an_added_token_equal_the_untouched_library():
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b  c\n<|endoftext|>\td", "<|endoftext |> <|ENDOFTEXT|> x", "plain text"] * 2
    whole = Tokenizer.from_file(TOKENIZER)
    enc = ChunkEncoder(TOKENIZER)
    got = [list(np.frombuffer(b, enc.dtype)) for b in enc.encode_many(texts)]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts] and got[0] == [87, 220, 50256, 331]


@here
def test_op5(spark, ids):
    at = 0
    for r in sorted(queries.op5_token_store(spark, SF).collect()):
        want = ids[r["doc_id"]] + [0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(want), crc(want))
        at += len(want)
    assert at == sum(len(v) + 1 for v in ids.values())


@here
def test_store_reads_one_document_and_guards_its_files(spark, ids):
    path = scratch_path(spark, "test-store")
    token_store.write_store(table(spark, "documents"), path, TOKENIZER, max_file_bytes=20000)
    dictionary = token_store.load_dictionary(spark, path)
    row = spark.read.parquet(f"{path}/manifest").orderBy("start").first()
    file = token_store.StoreFile(path, row["name"], dictionary)
    assert list(file.ids(2)) == ids[file.index["id"][2].as_py()] + [0]
    with pytest.raises(ValueError):
        token_store.StoreFile(path, row["name"], b"another")
    assert spark.read.parquet(f"{path}/manifest").count() > 1 and not os.listdir(f"{path}/tmp")


@here
def test_op6(spark, ids):
    rows = queries.op6_packing(spark, SF).collect()
    for r in rows:
        part = (ids[r["doc_id"]] + [2])[r["start"]:r["start"] + r["length"]]
        assert (len(part), crc(part)) == (r["length"], r["ids_crc32"])
    of = defaultdict(list)
    for r in rows:
        of[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for key, parts in of.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts))) and all(p[2] == 1024 for p in parts[1:])
        assert [p[1] for p in parts] == list(np.cumsum([0] + [p[2] for p in parts[:-1]])) and sum(p[2] for p in parts) == len(ids[key]) + 1
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
        assert o2 == (o + n if s == s2 else 0) and o + n <= 1024
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 1024) * 1.03 + 1


def test_plans_hold_all_pieces():
    rng = random.Random(3)
    for _ in range(300):
        cap = rng.randint(1, 40)
        have = Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 60)))
        kinds = packing.plan(dict(have), cap)
        got = Counter()
        for lengths, n in kinds:
            assert n > 0 and 0 < sum(lengths) <= cap and sum(3 * x > cap for x in lengths) <= 2
            for x in lengths:
                got[x] += n
        assert got == +have
        ranks = defaultdict(list)
        for n, lo, hi, *_ in packing.placements(kinds):
            ranks[n] += range(lo, hi)
        assert all(sorted(v) == list(range(have[n])) for n, v in ranks.items())


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))


def groups(nodes, linked):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@here
def test_op3(spark):
    got = {r["doc_id"]: r for r in queries.op3_simhash(spark, SF).collect()}
    bits = {r["doc_id"]: plain_fingerprint(r["text"]) for r in table(spark, "documents").collect()}
    near = [(a, b) for a in bits for b in bits if a < b and (bits[a] ^ bits[b]).bit_count() <= 2]
    root = groups(bits, near)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{b:016x}", root[i]) for i, b in bits.items()}


@pytest.mark.parametrize("key_rows", [1, 4, 10**6])
def test_links_of_crowded_blocks(spark, key_rows):
    rng, prints = random.Random(5), set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(30):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    prints = sorted(prints)
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    pairs = {(j, i) for i, p in enumerate(prints) for j in range(i + 1, len(prints)) if (p ^ prints[j]).bit_count() <= 2}
    linked = simhash.links(spark.createDataFrame(rows, "bits bigint, rep bigint"), 2, key_rows)
    got = {tuple(r) for r in linked.collect()}
    assert got <= pairs and (key_rows < 10**6 or got == pairs)
    root = groups(range(len(prints)), pairs)
    assert {r["node"]: r["root"] for r in simhash.components(linked).collect()} == {n: root[n] for n in root if root[n] != n}


def test_long_chains(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(900, 800)], "a bigint, b bigint")
    assert {r["root"] for r in simhash.components(edges).where("node < 500").collect()} == {0}


@here
def test_op9(spark):
    bench, docs = table(spark, "benchmark").collect(), table(spark, "documents").collect()
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for r in bench:
        w = words(r["text"])
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add(str(r["item_id"]))
    got = {r["doc_id"]: r for r in queries.op9_decontaminate(spark, SF).collect()}
    for r in docs:
        w, hit, items = words(r["text"]), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    items |= windows[tuple(w[i:i + n])]
        have = got[r["doc_id"]]
        assert tuple(have[1:]) == (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))


def test_automaton_against_search():
    rng = random.Random(4)
    for _ in range(400):
        window = rng.randint(1, 5)
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))) for i in range(rng.randint(0, 5))]
        auto = decontaminate.Automaton(items, window)
        texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 25))) for _ in range(4)]
        for text, (n, spans, names) in zip(texts, decontaminate.find(auto, texts)):
            w, hit, found = text.split(), set(), set()
            for name, item in items:
                v = item.split()
                for j in range(max(1, len(v) - window + 1) if v else 0):
                    part = v[j:j + window]
                    for i in range(len(w) - len(part) + 1):
                        if w[i:i + len(part)] == part:
                            hit |= set(range(i, i + len(part)))
                            found.add(name)
            assert (n, {x for a, b in spans for x in range(a, b)}, names) == (len(w), hit, found)


def test_benchmark_blocks_and_cutting(spark):
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))
    items = [(i, text(30)) for i in range(40)]
    docs = [(i, f"{text(40)}, {items[i][1].upper()}! {text(40)}" if i % 2 else text(80)) for i in range(20)]
    docs.append((99, items[3][1] + " tail"))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted((r["doc_id"], r["n_hit"], r["items"]) for r in decontaminate.report(df, bench).collect())
    assert one == sorted((r["doc_id"], r["n_hit"], r["items"]) for r in decontaminate.report(df, bench, block_bytes=900).collect())
    left = {r["doc_id"]: r["text"] for r in decontaminate.clean(df, bench, block_bytes=900).collect()}
    assert set(left) == set(range(20))
    for i, t in docs[:20]:
        if i % 2:
            head, tail = t.split(items[i][1].upper())
            assert left[i] == head + tail
        else:
            assert left[i] == t


def test_line_templates(spark):
    long = "one two three four five six seven {} nine ten"
    docs = [(i, long.format(w) + "\nown line %s here it is for document number" % w) for i, w in enumerate(["a", "b", "c7"])]
    docs += [(10, "short line"), (11, "short line"), (12, "alone it stands with many words in it today\n\nshort line")]
    docs += [(20 + i, "visited by user%d at %d:30 on some day in may" % (i, i)) for i in range(3)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got[0] == docs[0][1]
    assert [got[i].split("\n")[0] for i in (1, 2)] == ["own line b here it is for document number", "own line c7 here it is for document number"] or (
        got[1] == "" and got[2] == "")
    assert got[10] == got[11] == "short line" and got[12] == docs[5][1]
    assert got[20] == docs[6][1] and got[21] == got[22] == ""


def by_sql(docs):
    import duckdb
    import pandas as pd

    documents = pd.DataFrame(docs, columns=["doc_id", "text"])  # noqa: F841 - the SQL reads it
    return duckdb.sql(f"SELECT * FROM ({queries.OP2_SQL}) ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("n", [20, 10000])
def test_line_templates_do_not_depend_on_the_leafs_size(spark, n):
    line = "the user account named {} was opened from the city of {} without any error"
    docs = [(i, line.format(f"name{chr(97 + i % 100 // 10)}{chr(97 + i % 10)}", f"city{chr(97 + (i + i // 100) % 100 // 10)}{chr(97 + (i + i // 100) % 10)}"))
            for i in range(n)]
    # a second template of the leaf, in few lines of it
    docs += [(20000 + i, f"the user account of some other kind stays closed until {w} comes back") for i, w in enumerate(["may", "june", "july"])]
    assert len({t for _, t in docs}) == len(docs)
    got = line_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string")).where("text <> ''")
    assert [r["doc_id"] for r in got.orderBy("doc_id").collect()] == [0, 20000]
    assert [i for i, text, _ in by_sql(docs) if text] == [0, 20000]


def test_quality_sample_has_one_row_an_id(spark, monkeypatch):
    docs = [(1, f"text {i} of the hot id " * (i + 1)) for i in range(50)] + [(i, f"a text of its own {i}") for i in range(2, 9)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality_rules, "train", lambda x, y, names: seen.extend([x.shape, sorted(y)]))
    quality_rules.fit(spark.createDataFrame(docs, "doc_id bigint, text string"), labels)
    assert seen[0][0] == 8 and seen[1] == [0.0] * 4 + [1.0] * 4


def test_number_rows_stay(spark):
    rows = ["10 20 30 40 50 60 70 80", "11 21 31 41 51 61 71 81", "11 21 31  41 51 61 71 81\r", "a1 20 30 40 50 60 70 total"]
    docs = [(i, t) for i, t in enumerate(rows)] + [(10 + i, f"page {i}") for i in range(12)] + [(30 + i, "page 40") for i in range(12)]
    docs += [(50 + i, f"seen on day {i} by all of us here") for i in range(3)]
    got = line_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string")).where("text <> ''")
    assert [r["doc_id"] for r in got.orderBy("doc_id").collect()] == [0, 1, 3, *range(10, 22), 30, 50]
    assert [i for i, text, _ in by_sql(docs) if text] == [0, 1, 3, *range(10, 22), 30, 50]


def test_line_sql_on_crowded_leaves(spark):
    """Leaves of several templates, fields of many and few values, rows of numbers: operator and SQL say the same."""
    rng = random.Random(3)
    kinds = ["the job {} of user {} ended after {} seconds on node {} without errors", "the job {} of node {} was sent back by {} for the reason {} again",
             "total {} {} {} {} {} for part {} of {}", "the job of {} {}", "{} {} {} {} {} {} {} {} {}"]
    fields = [lambda: str(rng.randint(1, 30)), lambda: rng.choice("abcdefgh") * rng.randint(1, 12), lambda: rng.choice(["red", "blue"])]
    docs = []
    for i in range(400):
        lines = [re.sub("{}", lambda m: rng.choice(fields)(), rng.choice(kinds)) for _ in range(rng.randint(0, 6))]
        docs.append((i, "\n".join(lines) if i % 50 else None))
    got = line_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string"), count="n_dropped").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == by_sql(docs)
    assert sum(n for _, _, n in by_sql(docs)) > 100


def test_topk_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.standard_normal((400, 12)).cumsum(1), 3).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    whole = np.floor(256 * x.astype(float)).astype(int)
    for block in (3, 2048):
        got = sorted(tuple(r) for r in topk.nearest(df, F.col("vec_id") % 20 == 0, k=5, block=block, rows=64).collect())
        want = []
        for q in range(0, 400, 20):
            best = sorted((-int(whole[q] @ whole[c]), c) for c in range(400) if c != q)[:5]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
        assert got == want


def test_segment_bounds_never_cut_a_match():
    rng = np.random.default_rng(9)
    x, y = rng.integers(-200, 200, (50, 13)), rng.integers(-200, 200, (60, 13))
    for n in topk.LEVELS:
        assert (topk.segment_stats(x.astype(float), n) @ topk.segment_stats(y.astype(float), n).T >= x @ y.T - 1e-3).all()


def runs(spark, rows, monkeypatch):
    """The rows in two orders, splits and settings; borders are drawn from few of them."""
    monkeypatch.setattr(storage, "BORDER_ROWS", 20)
    monkeypatch.setattr(storage, "ROWS_A_RANGE", 2)
    monkeypatch.setattr(storage, "FEWEST_RANGES", 12)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        for count, splits in ((8, 1), (3, 7)):
            spark.conf.set(name, str(count))
            yield rows.repartition(splits, F.rand(splits))
    finally:
        spark.conf.set(name, before)


@here
def test_warc_is_deterministic_and_readable(spark, monkeypatch):
    pages = table(spark, "pages")
    digests = []
    for some in runs(spark, pages, monkeypatch):
        path = scratch_path(spark, "test-warc")
        warc.write_archives(some, path, max_file_bytes=30000)
        rows = spark.read.parquet(f"{path}/manifest").orderBy("name").collect()
        digests.append([(r["name"], r["sha256"]) for r in rows])
        assert len({r["part"] for r in rows}) > 6
        for r in rows:
            data = open(f"{path.replace('file:', '')}/{r['name']}", "rb").read()
            assert hashlib.sha256(data).hexdigest() == r["sha256"] and zlib.decompress(data, 31).startswith(b"WARC/1.1\r\n")
    assert digests[0] == digests[1]
    back = {r["id"]: r["payload"].decode() for r in warc.read_archives(spark, path, content=True).collect() if r["payload"] is not None}
    assert back == {r["page_id"]: r["html"] for r in pages.collect()}


@here
def test_store_files_are_deterministic(spark, monkeypatch):
    found = []
    for some in runs(spark, table(spark, "documents"), monkeypatch):
        path = scratch_path(spark, "test-store")
        token_store.write_store(some, path, TOKENIZER, max_file_bytes=20000)
        names = [r["name"] for r in spark.read.parquet(f"{path}/manifest").orderBy("start").collect()]
        found.append([(n, hashlib.sha256(open(f"{path.replace('file:', '')}/{n}", "rb").read()).hexdigest()) for n in names])
    assert len(found[0]) > 6 and found[0] == found[1]


def test_ranges_of_hot_keys_and_nulls(spark):
    rows = [(None, 5, 10)] * 3 + [("hot", 1, 100)] * 40 + [(f"k\"{i}\u00e9", i, 10) for i in range(60)]
    light = spark.createDataFrame(rows, "id string, tie bigint, size bigint")
    count, part = storage.ranges(light, ["id", "tie"], "size")
    got = sorted(((r["id"] is not None, r["id"] or "", r["tie"]), r["part"]) for r in light.withColumn("part", part).collect())
    assert [p for _, p in got] == sorted(p for _, p in got) and 0 <= got[0][1] and got[-1][1] < count == 32
    assert len({p for k, p in got if k[1] == "hot"}) == 1 and len({p for _, p in got}) > 4
    empty = storage.ranges(light.limit(0), ["id", "tie"], "size")
    assert empty[0] == 1


def test_network_gradients():
    old = toxicity.TELLING
    toxicity.TELLING = 0.0
    try:
        vocabulary = toxicity.Vocabulary([["ab", "bc", "idiot", "x"], ["ab", "cd"], ["idiot", "cd"], ["qq"]], [1, 0, 1, 0])
    finally:
        toxicity.TELLING = old
    net, rng = toxicity.Network(vocabulary), np.random.default_rng(0)
    net.p = {k: v.astype(float) + 0.05 * rng.standard_normal(v.shape) for k, v in net.p.items()}
    net.p["word"][0] = net.p["char"][0] = 0
    numbers, rows, runs = vocabulary.rows(["ab", "bc", "idiot", "x", "cd", "qq", "zzz"])
    parts = np.append(0, numbers)[np.array([[1, 2, 3, 4, 0, 0], [1, 5, 4, 0, 0, 0], [3, 3, 7, 6, 1, 2]])]
    parts = np.concatenate([parts, np.zeros((3, toxicity.WINDOW - 6), int)], 1)
    y = np.array([1, 0, 1.0])

    def loss():
        s = net.forward(net.gates(net.inputs(rows, runs)[0]).astype(float), parts)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).sum()

    _, grad = net.gradients(rows, runs, parts, y, np.ones(3))
    for name, values in net.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in values.shape)
            if name in ("word", "char") and at[0] == 0:
                continue
            values[at] += 1e-3
            up = loss()
            values[at] -= 2e-3
            down = loss()
            values[at] += 1e-3
            assert abs((up - down) / 2e-3 - np.asarray(grad[name])[at]) < 1e-3, name


@here
@pytest.mark.parametrize("name, label, parts, rest, least", [("op10_toxicity", "toxic", 3, 1, 0.8), ("op1_quality_rules", "quality", 4, 2, 0.9)])
def test_held_out_accuracy(spark, name, label, parts, rest, least):
    folder = "/root/testdata/sf0.01"
    found = queries.all_queries()[name](spark, folder)
    got = {r["doc_id"]: r for r in found.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % parts == rest) and r["predicted"] == int(r["score"] >= 0.7) for i, r in got.items())
    right = [got[r["doc_id"]]["predicted"] == r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert len(right) > 50 and sum(right) / len(right) >= least


def test_compiled_rules_equal_their_matrix(spark):
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.4) & (x[:, 2] < 0.8)).astype(float)
    model = quality_rules.train(x, y, ["a", "b", "c"])
    got = spark.createDataFrame([tuple(map(float, v)) for v in x], "a double, b double, c double").select(model.column().alias("s")).collect()
    margin = model.bias + sum(w * r.matrix(["a", "b", "c"], x) for r, w in model.rules)
    assert np.allclose([r["s"] for r in got], 1 / (1 + np.exp(-margin)))
    assert (((np.array([r["s"] for r in got]) > 0.5) == (y == 1)).mean() > 0.97) and 0 < len(model.rules) < 80


def test_sum_product_against_enumeration():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = int(rng.integers(1, 9))
        parents = np.array([-1, *[int(rng.integers(0, i)) for i in range(1, n)]])
        kinds, theta, links = rng.integers(0, 3, n), rng.standard_normal(n) * 2, rng.standard_normal((3, 2, 2)) * 2
        total, belief, pairs = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for bits in range(1 << n):
            s = np.array([bits >> i & 1 for i in range(n)])
            weight = np.exp((theta * s).sum() + sum(links[kinds[i], s[parents[i]], s[i]] for i in range(1, n)))
            total += weight
            belief += weight * s
            for i in range(1, n):
                pairs[i, s[parents[i]], s[i]] += weight
        got, got_pairs, partition = html_extract.marginals(parents, kinds, theta, links)
        assert np.allclose(got, belief / total) and np.allclose(got_pairs[1:], pairs[1:] / total) and np.isclose(partition, np.log(total))


def test_extraction_on_unseen_layouts():
    model = html_extract.default_model()
    right = wrong = missed = 0
    pages = html_extract.labelled_pages(80, seed=99)
    for page, blocks in zip(pages, model.content(pages)):
        parsed = html_extract.Page(page)
        gold = Counter(t for t, g in zip(parsed.text, parsed.gold) if t is not None and g)
        got = Counter(blocks)
        right += sum((gold & got).values())
        wrong += sum((got - gold).values())
        missed += sum((gold - got).values())
    assert right > 50 * (wrong + missed) / 2


FIRST = ("The long first paragraph of the article tells how the river rose in spring, and why the town moved its market to the "
         "hill. It was a slow change, but nobody wanted to go back.")
SECOND = ("In the second paragraph the writer explains, with many numbers, what the move cost. Some families lost a house; "
          "others won a better place, closer to the new road.")
PARAGRAPHS = f"<p>{FIRST}</p><p>{SECOND}</p>"
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/b">About us</a></li></ul></nav>'
FOOT = "<footer>&copy; example</footer>"
WHOLE_PAGES = {
    "head left open": f"<html><head><title>x y</title><body>{NAV}<article>{PARAGRAPHS}</article>{FOOT}</body></html>",
    "no head end, no body": f"<html><head><title>x y</title><meta charset=utf-8>{NAV}<article>{PARAGRAPHS}</article>{FOOT}",
    "no html": f"<head><title>x</title><div class=content>{PARAGRAPHS}</div>",
    "svg with a slash": f'<body>{NAV}<article><svg class="icon" viewBox="0 0 1 1"/>{PARAGRAPHS}</article>{FOOT}</body>',
    "svg with slashes inside": f'<body><svg/>{NAV}<article>{PARAGRAPHS}<svg><path d="x"/><title/></svg></article>{FOOT}</body>',
    "svg left open": f'<body>{NAV}<article><svg><path d="x">{PARAGRAPHS}</article>{FOOT}</body>',
    "body names a sidebar": f'<body class="single has-sidebar">{NAV}<article>{PARAGRAPHS}</article>{FOOT}</body>',
    "wrapper names a sidebar": (f'<body><div class="page-with-sidebar">{NAV}<article>{PARAGRAPHS}</article>'
                                f'<div class="sidebar"><p>Popular posts</p></div></div>{FOOT}</body>'),
    "wrapper alone": f'<body class="single has-sidebar"><div class="page-with-sidebar">{PARAGRAPHS}</div></body>',
    "page in a form": f'<body><form id="aspnetForm" method="post">{NAV}<article>{PARAGRAPHS}</article>{FOOT}</form></body>',
    "article in a form": f'<body><form id="form1"><div class="content">{PARAGRAPHS}</div></form></body>',
}


@pytest.mark.parametrize("name", WHOLE_PAGES)
def test_extraction_keeps_whole_articles(name):
    assert html_extract.default_model().content([WHOLE_PAGES[name]]) == [[FIRST, SECOND]]


def test_extraction_of_bare_text():
    assert html_extract.default_model().content([FIRST, f"<html><body>{FIRST}</body></html>"]) == [[FIRST], [FIRST]]


@here
def test_op8(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in table(spark, "pages").collect()}
    for r in queries.op8_html_extract(spark, SF).collect():
        inner = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


@here
def test_pipeline(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    left, kept = table(spark, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, left, SF).write.parquet(path)
        left = spark.read.parquet(path)
        kept[name] = {r["doc_id"]: (r["text"], r["n_chars"]) for r in left.collect()}
        assert all(n == len(t) for t, n in kept[name].values())
    assert set(kept["line_dedup"]) == set(kept["toxicity"]) and 0.7 * len(docs) < len(kept["toxicity"]) <= len(docs)
    seen = defaultdict(set)
    for i, (t, _) in kept["line_dedup"].items():
        for line in t.split("\n"):
            if len(line.split()) >= 8:
                seen[line].add(i)
    assert max(map(len, seen.values())) == 1
    prints = {i: plain_fingerprint(t) for i, (t, _) in kept["line_dedup"].items()}
    root = groups(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert set(kept["simhash_near_dedup"]) == set(root.values())
    after = spark.read.parquet(path)
    assert decontaminate.report(after, table(spark, "benchmark")).where("n_hit > 0").count() == 0
    assert set(kept["decontamination"]) <= set(kept["simhash_near_dedup"])
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == set(kept["decontamination"])


def test_training_on_batches_without_known_inputs():
    clean = [[["plain", "words"]], [["other", "words"]], [["quiet"]]] * 9
    toxic = [[["you", "idiot"], ["nothing", "here"]], [["an", "idiot"]]] * 9
    net = toxicity.train(clean + toxic, [0] * 27 + [1] * 18, batch=1, least_steps=50)
    assert toxicity.score_texts(net, ["an idiot", "plain words"])[0] > toxicity.score_texts(net, ["plain words"])[0]
