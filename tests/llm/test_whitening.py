"""Whitening against numpy on the whole matrix, exact integers against Python's."""

import numpy as np
import pytest

from cartwheel.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, id string, x int"


def check(rows, found, components):
    good = [(i, [int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(v) for _, v in good})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    centred = np.array([[(n * v[j] - sums[j]) / n for j in range(d)] for v in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(found) == len(good) * components
    want = {}
    for i, v in good:
        z = np.array([(n * v[j] - sums[j]) / n for j in range(d)]) @ axes[:, :components] / np.sqrt(values[:components])
        want.setdefault(i, []).append((sum((n * v[j] - sums[j]) ** 2 for j in range(d)), z))
    signs, seen = {}, {}
    for r in found:
        far = [w for w in want[r["id"]] if w[0] == r["deviation"]]
        assert far and r["n"] == n
        z = far[0][1][r["component"] - 1]
        if abs(z) > 1e-3:
            assert signs.setdefault(r["component"], np.sign(z * r["whitened"])) == np.sign(z * r["whitened"])
        assert abs(abs(z) - abs(r["whitened"])) < 1e-7
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-9
        assert r["identity_error"] < 1e-9
        seen[r["id"]] = seen.get(r["id"], 0) + 1
    assert seen == {i: components * len(w) for i, w in want.items()}


@pytest.mark.parametrize("size,block,slab,cols", [(5, 8, 3, 1024), (5, 4096, 16384, 1024), (7, 16, 2, 3)])
def test_whitening_equals_numpy(spark, monkeypatch, size, block, slab, cols):
    monkeypatch.setattr(whitening, "SLAB", slab)
    monkeypatch.setattr(whitening, "BLOCK_COLS", cols)
    rng = np.random.default_rng(size)
    rows = [(i, [float(c) for c in rng.standard_normal(size) * np.arange(1, size + 1)]) for i in range(100)]
    rows += [(500 + i, rows[3][1]) for i in range(60)] + [rows[5], (7, [1.0] * size), (None, [2.0] * size)]
    rows += [(900, None), (901, [1.0] * (size - 1) + [None]), (902, [float("nan")] * size), (903, [float("inf")] + [1.0] * (size - 1))]
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    table = spark.createDataFrame([(i, v, "k", 1) for i, v in rows], SCHEMA)
    found = whitening.whiten(table, components=4, block_rows=block).collect()
    check(rows, found, 4)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0], "k", 1), (2, [1.0, 2.0], "k", 1), (3, [], "k", 1)], SCHEMA)
    assert whitening.whiten(one).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 0.0, -float(i)], "k", 1) for i in range(6)], SCHEMA)
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}
    # two lengths, each with a fit list of its own; entries that no 64-bit integer holds take no part
    mixed = [(i, [float(i), float(i * i)], "k", 1) for i in range(8)] + [(20 + i, [float(i)], "k", 1) for i in range(5)] + [
        (40, [3e38, 1.0], "k", 1)]
    found = whitening.whiten(spark.createDataFrame(mixed, SCHEMA)).collect()
    assert {(r["id"] >= 20, r["n"]) for r in found} == {(False, 8), (True, 5)} and len(found) == 8 * 2 + 5


def test_large_integers_stay_exact(spark):
    rows = [(i, [float(2 ** 40 + i * 2 ** 20), float(i)]) for i in range(20)]
    table = spark.createDataFrame([(i, v, "k", 1) for i, v in rows], "vec_id bigint, embedding array<double>, id string, x int")
    found = {r["id"]: r["deviation"] for r in whitening.whiten(table).collect()}
    xs = [[int(64 * c) + 1_000_000 for c in v] for _, v in rows]
    for i in range(20):
        far = sum((20 * xs[i][j] - sum(x[j] for x in xs)) ** 2 for j in range(2))
        assert found[i] == (far if far < 1 << 63 else None)
