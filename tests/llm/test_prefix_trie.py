"""The prefix trie against a plain dictionary of prefixes, with tiny shards so that most nodes lie on a border."""

import hashlib
import random
import zlib

import pytest

from cartwheel.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, shard int"


def plain(rows, every=100, most=6):
    turns = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    turns = {c: [(x[3], x[4]) for x in sorted(t)] for c, t in turns.items()}
    nodes = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % most
        path = tuple(turns.get(conv - conv % every, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            node = nodes.setdefault(path[:d], {"members": [], "ends": []})
            node["members"].append(conv)
            if d == len(path):
                node["ends"].append(conv)
    out = []
    for path, node in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        kids = sum(len(p) == len(path) + 1 for p in below)
        leaves = sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below) for p in below)
        saved = sum((len(nodes[p]["members"]) - 1) * (len(p[-1][1]) if p else 0) for p in below)
        out.append((min(node["members"]), len(path), min(nodes[path[:-1]]["members"]) if path else None,
                    len(node["members"]), kids, leaves, saved,
                    hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(0, 3 * n, rng.choice([1, 2, 3])):
        kind = rng.random()
        size = 40 if kind < 0.02 else rng.randint(0, 7)
        for t in range(size):
            text = "hot" if kind > 0.6 else rng.choice(["a", "bé", "", None, "a longer text"])
            rows.append((conv, None if rng.random() < 0.05 else t if rng.random() < 0.9 else 1,
                         rng.choice(["user", "user", None]) if kind <= 0.6 else "user", text, "k", 1))
    rows += rows[:5] + [(None, 1, "user", "x", "k", 1), (100, None, None, None, "k", 1)]
    return rows


@pytest.mark.parametrize("seed,limit", [(1, 9), (2, 60), (3, 100_000), (4, 1)])
def test_trie_equals_plain_prefixes(spark, seed, limit):
    rows = made(seed)
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), shard_turns=limit)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)


def test_one_hot_conversation_and_empty_table(spark):
    rows = [(c, t, "user", f"turn {t}", "k", 1) for c in range(1, 400) for t in range(3)] + [(7000, 0, "user", "turn 0", "k", 1)]
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), shard_turns=50)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_median_insertion_keeps_sibling_trees_low():
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.by_medians(1023):
        tree.insert([i], [1])
    heights = {}
    def height(node):
        return 0 if node < 0 else heights.setdefault(node, 1 + max(height(tree.low[node]), height(tree.high[node])))
    assert height(tree.down[0]) == 10
