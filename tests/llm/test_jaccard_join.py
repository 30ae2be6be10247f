"""The n-gram join against all pairs of sets."""

import random
import re

import pytest

from cartwheel.llm import jaccard_join
from cartwheel.llm.simhash import LOWER

SCHEMA = "doc_id bigint, text string, code string, token int"


def grams(text, n=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, percent=85, n=4):
    sets = [(i, grams(t, n)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return sorted(((i, len(a), None if i is None else root(i)) for i, a in sets), key=str)


def documents(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = " ".join(rng.choice(words) for _ in range(60))
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 5, 40, 90, 300]))] for _ in range(8)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.7:  # copies of a few texts with some words changed, some of them copies of copies
            text = list(rng.choice(bases[:3] if kind < 0.4 else bases))
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(len(text))] = rng.choice(words).upper()
            if rng.random() < 0.2:
                bases.append(text)
            rows.append((i, " ".join(text)))
        elif kind < 0.85:
            rows.append((i, common + " " + " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))))
        else:
            rows.append((i, rng.choice([None, "", " \n", "one", "One", "a b c", "a b c d", " ".join(rng.choice(words) for _ in range(30))])))
    return rows + [(None, rows[0][1]), (3, rows[7][1]), rows[5], rows[5]]


@pytest.mark.parametrize("seed,block", [(1, 1 << 16), (2, 300), (3, 40)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", block)
    rows = documents(seed)
    table = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    found = sorted(map(tuple, jaccard_join.similar_sets(table).collect()), key=str)
    assert found == brute(rows)


def test_links_without_the_stars(spark, monkeypatch):
    """Groups alone find every link: no star joins anything beforehand."""
    monkeypatch.setattr(jaccard_join, "star_links", lambda sets, marks, percent: spark.createDataFrame([], "a bigint, b bigint"))
    rows = documents(9, 90)
    table = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    assert sorted(map(tuple, jaccard_join.similar_sets(table).collect()), key=str) == brute(rows)


def test_empty_and_the_bound():
    member = [{"number": 1, "root": 1, "tokens": list(range(100))}, {"number": 2, "root": 2, "tokens": [500]}]
    query = [{"number": 3, "root": 3, "tokens": list(range(8, 100))}, {"number": 4, "root": 4, "tokens": [500, 501]},
             {"number": 5, "root": 1, "tokens": list(range(100))}]
    assert jaccard_join.compare(member, query, 85) == [(3, 1)]


def test_empty_table(spark):
    assert jaccard_join.similar_sets(spark.createDataFrame([], SCHEMA)).collect() == []
