"""Quality scores by a sparse rule ensemble, compiled into Spark column expressions.

Statistics of a text are Spark columns. On a bounded sample of labelled rows (``SAMPLE`` of each kind) small boosted
trees are grown over them; every path from a root becomes a rule, a conjunction of thresholds. A logistic model with
an absolute-value penalty weighs the rules, which leaves few; these and the bias become one column expression, so
scoring runs in generated code without Python.

Defined results: null and empty texts have the statistics of an empty text (all zero) and are scored
by the rules like any other; without labelled rows of both kinds the score is the share of label 1, or 0.5 without any;
repeated rows score alike; other columns are ignored, or kept by :func:`score`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each kind that training reads.
SAMPLE = 6000
BINS, DEPTH, TREES, RATE = 32, 3, 24, 0.3
PENALTY, ROUNDS = 0.002, 400


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a text, by name."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    chars = F.length(text)
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    n = F.size(words)
    share = lambda part, of: F.when(of > 0, part / of).otherwise(F.lit(0.0)).cast("double")
    without = lambda pattern: chars - F.length(F.regexp_replace(text, pattern, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    return {
        "words": n.cast("double"),
        "word_chars": share(chars, n),
        "upper": share(without("[A-ZÀ-Þ]+"), chars),
        "marks": share(without(r"[!#$%&*+<=>@\\^`{|}~\[\]_/]+"), chars),
        "stops": share(without("[.,;:?]+"), chars),
        "digits": share(without("[0-9]+"), chars),
        "distinct": share(F.size(F.array_distinct(words)), n),
        "line_words": share(n, F.size(lines)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
    }


@dataclass(frozen=True)
class Rule:
    """Holds where every named statistic is over (or not over) its threshold."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        one = lambda t: (F.col(t[0]) > t[2]) if t[1] else (F.col(t[0]) <= t[2])
        return F.when(reduce(Column.__and__, map(one, self.terms)), 1.0).otherwise(0.0)

    def matrix(self, names: list[str], x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, over, at in self.terms:
            v = x[:, names.index(name)]
            out &= (v > at) if over else (v <= at)
        return out


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def column(self) -> Column:
        """The score, over columns named as the statistics."""
        return 1 / (1 + F.exp(-_total([F.lit(self.bias), *(r.column() * w for r, w in self.rules)])))


def _total(parts: list[Column]) -> Column:
    """A sum as a shallow tree."""
    while len(parts) > 1:
        parts = [reduce(Column.__add__, parts[i:i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def _grow(x: np.ndarray, gain: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], names: list[str]):
    """Leaves of one tree as (rule terms, member rows, value); splits by second-order gain."""
    done, open_ = [], [((), np.arange(len(x)))]
    while open_:
        terms, rows = open_.pop()
        best = (1e-6, None)
        g, h = gain[rows].sum(), weight[rows].sum()
        if len(terms) < DEPTH and len(rows) >= 20:
            for f, points in enumerate(cuts):
                if not len(points):
                    continue
                place = np.searchsorted(points, x[rows, f], "left")  # value <= points[place]
                left_g = np.cumsum(np.bincount(place, gain[rows], len(points) + 1))[:-1]
                left_h = np.cumsum(np.bincount(place, weight[rows], len(points) + 1))[:-1]
                n = np.cumsum(np.bincount(place, minlength=len(points) + 1))[:-1]
                better = left_g ** 2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g ** 2 / (h + 1)
                better[(n < 5) | (len(rows) - n < 5)] = 0
                k = int(better.argmax())
                if better[k] > best[0]:
                    best = (better[k], (f, points[k]))
        if best[1] is None:
            done.append((terms, rows, g / (h + 1)))
            continue
        f, at = best[1]
        over = x[rows, f] > at
        open_ += [(terms + ((names[f], True, float(at)),), rows[over]), (terms + ((names[f], False, float(at)),), rows[~over])]
    return done


def extract_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[Rule]:
    """Every path of the boosted trees, each once."""
    cuts = []
    for f in range(x.shape[1]):
        points = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0)
        cuts.append(points)
    margin = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    found: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        for terms, rows, value in _grow(x, y - p, p * (1 - p), cuts, names):
            margin[rows] += RATE * value
            for size in range(1, len(terms) + 1):
                found[Rule(tuple(sorted(terms[:size])))] = None
    return list(found)


def lasso(r: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> tuple[float, np.ndarray]:
    """Weights of a logistic model with an absolute-value penalty, by accelerated proximal steps."""
    w, bias = np.zeros(r.shape[1]), 0.0
    ahead, ahead_bias, t = w.copy(), bias, 1.0
    # a step the loss's curvature allows: a quarter of the largest eigenvalue, by power iteration
    v = np.ones(r.shape[1] + 1)
    for _ in range(20):
        u = r @ v[:-1] + v[-1]
        v = np.append(r.T @ (weight * u), (weight * u).sum())
        size = np.linalg.norm(v)
        v /= size or 1
    step = 4 / max(size, 1e-9)
    for _ in range(ROUNDS):
        wrong = weight * (1 / (1 + np.exp(-(r @ ahead + ahead_bias))) - y)
        raw = ahead - step * (r.T @ wrong)
        new = np.sign(raw) * np.maximum(np.abs(raw) - step * penalty, 0)
        new_bias = ahead_bias - step * wrong.sum()
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (last - 1) / t * (new - w)
        ahead_bias = new_bias + (last - 1) / t * (new_bias - bias)
        w, bias = new, new_bias
    return float(bias), w


def train(x: np.ndarray, y: np.ndarray, names: list[str]) -> Model:
    """Rules and their weights; both labels weigh the same."""
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rules = extract_rules(x, y, names)
    if not rules:  # too few rows, or all alike
        return Model(0.0)
    r = np.stack([rule.matrix(names, x) for rule in rules], 1).astype(float)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    bias, w = lasso(r, y, weight)
    return Model(bias, tuple((rules[i], float(w[i])) for i in np.flatnonzero(np.abs(w) > 1e-3)))


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Model:
    """A model for ``labels`` (of which ``usable`` rows may be read); the sample is drawn by a hash of the ids."""
    known = labels.where(usable) if usable is not None else labels
    known = known.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(
        F.max(F.col(label_col)).cast("int").alias("label"))
    draw = lambda kind: known.where(F.col("label") == kind).orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
    chosen = [(r["key"], r["label"]) for kind in (0, 1) for r in draw(kind).collect()]
    if not chosen:
        return Model(0.0)
    table = docs.sparkSession.createDataFrame(chosen, known.schema)
    # the sample has at most twice SAMPLE ids, one row for each whatever its number of rows
    picked = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(table), "key")
    stats = statistics(F.col("text"))
    described = picked.select("label", "key", F.struct(*[c.alias(n) for n, c in stats.items()]).alias("stats"))
    rows = described.groupBy("key", "label").agg(F.min("stats").alias("stats")).select("label", "key", "stats.*").collect()
    rows = sorted(rows, key=lambda r: (str(r["key"]), tuple(r)))
    x = np.array([[r[n] for n in stats] for r in rows], float).reshape(len(rows), len(stats))
    return train(x, np.array([r["label"] for r in rows], float), list(stats))


def score(docs: DataFrame, model: Model, column: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` and a ``column`` of scores from 0 to 1."""
    stats = statistics(F.col(text_col))
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    described = docs.select(kept, *[c.alias(n) for n, c in stats.items()])
    return described.select("row", model.column().alias("found")).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("found").alias(column))
