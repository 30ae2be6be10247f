"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is lower-cased and cut into words; a word's input is its own vector beside the mean of the vectors of
its character runs of 3 to 5 (with its ends marked), so unseen forms of a known stem still speak. Two gated
recurrent passes, one in each direction, read windows of words; attention pools their states
into one score for a window. All overlapping windows of a whole text are scored, and its score is the
greatest of them.

Training sees document labels only: at first every window of a toxic document counts as toxic, then only
its most toxic ones. It takes a bounded sample of labelled rows (``SAMPLE``), of each at most
``SAMPLE_WINDOWS`` windows spread over the whole text.

Defined results: null, empty and wordless texts score 0; words of over ``WORD`` characters are read in parts of
that size; without labelled rows of both kinds every text scores 0; repeated rows score alike;
other columns are kept and their names may be any.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm import storage

WINDOW, STRIDE = 64, 48
WORD = 32
#: Labelled documents of each kind that training reads, and windows of each.
SAMPLE, SAMPLE_WINDOWS = 1500, 24
WORD_DIM, CHAR_DIM, HIDDEN = 8, 16, 8
GRAMS = (3, 4, 5)
TABLE_BITS, COUNT_BITS = 20, 22
#: Inputs known to the model: at most so many words and character runs, whose rates in the sampled documents
#: of the two labels lie at least so many standard errors apart.
TELLING, MOST_WORDS, MOST_GRAMS = 6.0, 5_000, 20_000
BATCH = 400  # texts scored together
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    found = _WORD.findall((text or "").lower())
    if found and max(map(len, found)) > WORD:
        found = [w[i:i + WORD] for w in found for i in range(0, len(w), WORD)]
    return found


def gram_hashes(distinct: list[str]) -> np.ndarray:
    """64-bit hashes of the character runs of each word, 0 where there are none; (words, places)."""
    letters = np.array([f"\x02{w}\x03" for w in distinct], dtype=f"U{WORD + 2}").view(np.uint32)
    letters = letters.reshape(len(distinct), WORD + 2).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            code = np.full((len(distinct), WORD + 3 - n), n, np.uint64)
            for i in range(n):
                code = (code + letters[:, i:WORD + 3 - n + i]) * np.uint64(0x9E3779B97F4A7C15)
                code ^= code >> np.uint64(29)
            out.append(np.where(letters[:, n - 1:] > 0, code | np.uint64(1), np.uint64(0)))
    return np.concatenate(out, axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Vocabulary:
    """Rows of the input vectors of words and character runs that tell the labels apart; 0 for all others."""

    def __init__(self, documents: list[list[str]], labels: list[int]):
        labels = np.array(labels)
        sizes = [int((labels == k).sum()) for k in (0, 1)]
        in_docs: dict[str, list[int]] = {}
        for doc, label in zip(documents, labels):
            for w in set(doc):
                in_docs.setdefault(w, [0, 0])[label] += 1
        distinct = sorted(in_docs)
        counts = np.array([in_docs[w] for w in distinct], float).reshape(-1, 2)
        keep = _telling(counts, sizes)[:MOST_WORDS]
        self.word = {distinct[i]: n + 1 for n, i in enumerate(keep)}
        # runs are counted by a slot of their hash first, and only those of slots that may tell anything one by one
        slots = np.zeros((2, 1 << COUNT_BITS), np.int32)
        for doc, label in zip(documents, labels):
            np.add.at(slots[label], _grams_of(doc) >> np.uint64(64 - COUNT_BITS), 1)
        may_tell = np.zeros(1 << COUNT_BITS, bool)
        may_tell[_telling(np.minimum(slots.T, sizes), sizes, TELLING / 2)] = True
        found, in_kind = [], []
        for doc, label in zip(documents, labels):
            grams = _grams_of(doc)
            found.append(grams[may_tell[grams >> np.uint64(64 - COUNT_BITS)]])
            in_kind.append(np.full(len(found[-1]), label))
        grams, at = np.unique(np.concatenate(found), return_inverse=True)
        kinds = np.concatenate(in_kind)
        counts = np.stack([np.bincount(at[kinds == k], minlength=len(grams)) for k in (0, 1)], 1).astype(float)
        keep = _telling(counts, sizes)[:MOST_GRAMS][::-1]
        # of grams that meet in one slot the more telling one stays
        self.slot = np.zeros(1 << TABLE_BITS, np.int32)
        self.code = np.zeros(1 << TABLE_BITS, np.uint64)
        slots = (grams[keep] >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        self.slot[slots] = np.arange(1, len(keep) + 1)
        self.code[slots] = grams[keep]
        self.grams = len(keep) + 1

    def rows(self, distinct: list[str], size: int = 16384) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``ids, rows, runs``: a number for each word, 1 for all that are unknown and from 2 on for the others;
        and for each number less one its word's row and the rows of its character runs."""
        ids, rows, runs = [], [[0]], [np.zeros((1, _PLACES), np.int32)]
        used = 2
        for at in range(0, len(distinct), size):
            part = distinct[at:at + size]
            hashes = gram_hashes(part)
            slots = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            here = np.where(self.code[slots] == hashes, self.slot[slots], 0)
            row = np.array([self.word.get(w, 0) for w in part], np.int64)
            known = (row > 0) | here.any(1)
            number = np.ones(len(part), np.int64)
            number[known] = np.arange(used, used + known.sum())
            used += int(known.sum())
            ids.append(number)
            rows.append(row[known])
            runs.append(here[known])
        return np.concatenate(ids) if ids else np.zeros(0, np.int64), np.concatenate(rows).astype(np.int64), (
            np.concatenate(runs))


_MIX = np.random.default_rng(3).integers(1, 1 << 63, WINDOW, np.uint64) | np.uint64(1)
_PLACES = sum(WORD + 3 - n for n in GRAMS)


def _grams_of(doc: list[str]) -> np.ndarray:
    """The distinct character runs of a document's words, a bounded number of words at a time."""
    distinct = sorted(set(doc))
    parts = [np.unique(gram_hashes(distinct[at:at + 4096])) for at in range(0, len(distinct), 4096)]
    grams = np.unique(np.concatenate([np.zeros(1, np.uint64), *parts]))
    return grams[1:]


def _telling(counts: np.ndarray, sizes: list[int], least: float | None = None) -> np.ndarray:
    """Places of the features whose document rates differ most between the labels, most telling first."""
    least = TELLING if least is None else least
    rate = counts.sum(1) / sum(sizes)
    spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-9) * (1 / sizes[0] + 1 / sizes[1]))
    z = np.abs(counts[:, 1] / sizes[1] - counts[:, 0] / sizes[0]) / spread
    some = np.flatnonzero(z >= least)
    return some[np.argsort(-z[some], kind="stable")]


class Network:
    """Parameters and passes; all arrays are 32-bit, directions stand on the first axis."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 7):
        rng = np.random.default_rng(seed)
        size, h = WORD_DIM + CHAR_DIM, HIDDEN
        small = lambda *shape, by=0.1: (rng.standard_normal(shape) * by).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {
            "word": small(len(vocabulary.word) + 1, WORD_DIM), "char": small(vocabulary.grams, CHAR_DIM),
            "w": small(2, size, 3 * h, by=0.3), "u": small(2, h, 3 * h, by=0.3), "b": np.zeros((2, 1, 3 * h), np.float32),
            "pad": np.zeros((2, 1, 3 * h), np.float32), "v": small(2 * h), "o": small(2 * h, by=0.3),
            "c": np.zeros(1, np.float32)}
        self.p["word"][0] = self.p["char"][0] = 0

    def inputs(self, rows: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = np.maximum((runs > 0).sum(1), 1).astype(np.float32)
        # the unknown row is zero, so summing all places sums the known ones
        chars = np.zeros((len(rows), CHAR_DIM), np.float32)
        for place in range(runs.shape[1]):
            some = np.flatnonzero(runs[:, place])
            if len(some):
                chars[some] += self.p["char"][runs[some, place]]
        return np.concatenate([self.p["word"][rows], chars / known[:, None]], 1), known

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Input parts of the gates of each distinct word, the padding word first: (2, words + 1, 3h)."""
        return np.concatenate([self.p["pad"], np.matmul(x[None], self.p["w"]) + self.p["b"]], 1)

    def forward(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Scores of windows (rows of word numbers, 0 for padding); with ``keep`` what :meth:`backward` needs."""
        n, size = ids.shape
        h = HIDDEN
        state = np.zeros((2, n, h), np.float32)
        states = np.empty((size, 2, n, h), np.float32)
        steps = []
        u = self.p["u"]
        for t in range(size):
            x = np.stack([gates[0].take(ids[:, t], 0), gates[1].take(ids[:, size - 1 - t], 0)])
            inner = np.matmul(state, u)
            zr = sigmoid(x[..., :2 * h] + inner[..., :2 * h])
            z, r = zr[..., :h], zr[..., h:]
            new = np.tanh(x[..., 2 * h:] + r * inner[..., 2 * h:])
            if keep:
                steps.append((state, z, r, new, inner[..., 2 * h:]))
            state = new + z * (state - new)
            states[t] = state
        both = np.concatenate([states[:, 0], states[::-1, 1]], -1)  # (size, n, 2h)
        weight = both @ self.p["v"]
        weight = np.where(ids.T > 0, weight, np.float32(-1e9))
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, both)
        score = sigmoid(pooled @ self.p["o"] + self.p["c"][0])
        return (score, (steps, both, weight, pooled)) if keep else score

    def backward(self, ids: np.ndarray, wrong: np.ndarray, kept) -> tuple[dict, np.ndarray]:
        """Gradients, and that of the gates' inputs by window and step; ``wrong``: score minus label, weighted."""
        steps, both, weight, pooled = kept
        n, size = ids.shape
        h = HIDDEN
        grad = {k: np.zeros_like(self.p[k]) for k in ("w", "u", "b", "pad")}
        grad["o"], grad["c"] = pooled.T @ wrong, np.array([wrong.sum()], np.float32)
        d_pooled = wrong[:, None] * self.p["o"]
        d_weight = np.einsum("nh,tnh->tn", d_pooled, both)
        d_logit = weight * (d_weight - (weight * d_weight).sum(0))
        grad["v"] = np.einsum("tn,tnh->h", d_logit, both)
        d_both = weight[..., None] * d_pooled + d_logit[..., None] * self.p["v"]
        d_states = np.stack([d_both[..., :h], d_both[::-1, :, h:]], 1)  # (size, 2, n, h)
        d_gates = np.empty((size, 2, n, 3 * h), np.float32)
        flow = np.zeros((2, n, h), np.float32)
        for t in range(size - 1, -1, -1):
            state, z, r, new, inner = steps[t]
            flow = flow + d_states[t]
            d_new = flow * (1 - z) * (1 - new * new)
            d_z = flow * (state - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            d_inner = np.concatenate([d_z, d_r, d_new * r], -1)
            d_gates[t] = np.concatenate([d_z, d_r, d_new], -1)
            grad["u"] += np.matmul(state.transpose(0, 2, 1), d_inner)
            flow = flow * z + np.matmul(d_inner, self.p["u"].transpose(0, 2, 1))
        return grad, d_gates

    def gradients(self, rows: np.ndarray, runs: np.ndarray, ids: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        x, known = self.inputs(rows, runs)
        gates = self.gates(x)
        score, kept = self.forward(gates, ids, keep=True)
        grad, d_gates = self.backward(ids, ((score - labels) * weights).astype(np.float32), kept)
        words_here = gates.shape[1]
        d_table = np.stack([_sums(ids.T.ravel(), d_gates[:, 0], words_here),
                            _sums(ids.T[::-1].ravel(), d_gates[:, 1], words_here)])
        grad["pad"], d_table = d_table[:, :1], d_table[:, 1:]
        grad["b"] = d_table.sum(1, keepdims=True)
        grad["w"] = np.matmul(x.T[None], d_table)
        d_x = np.matmul(d_table, self.p["w"].transpose(0, 2, 1)).sum(0)
        grad["word"] = _sums(rows, d_x[:, :WORD_DIM], len(self.p["word"]))
        d_char = d_x[:, WORD_DIM:] / known[:, None]
        at = np.flatnonzero(runs.ravel())
        grad["char"] = _sums(runs.ravel()[at], d_char[at // runs.shape[1]], len(self.p["char"]))
        grad["word"][0] = grad["char"][0] = 0
        return score, grad


def _sums(keys: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    values = values.reshape(len(keys), values.shape[-1])
    return np.stack([np.bincount(keys, values[:, i], size) for i in range(values.shape[1])], 1).astype(np.float32)


def windows(numbers: list[int]) -> list[list[int]]:
    """All windows of a text's word numbers: every ``STRIDE`` words, the last one at its end."""
    last = len(numbers) - WINDOW
    if last <= 0:
        return [numbers + [0] * -last] if numbers else []
    starts = [*range(0, last, STRIDE), last]
    return [numbers[s:s + WINDOW] for s in starts]


def train(documents: list[list[list[str]]], labels: list[int], epochs: int = 6, least_steps: int = 150, batch: int = 192,
          rate: float = 0.01, seed: int = 7) -> Network | None:
    """A network fitted to documents, each a list of windows of words, and their labels; small samples are
    read again until ``least_steps`` batches were taken."""
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    net = Network(Vocabulary([[w for part in doc for w in part] for doc in documents], labels), seed)
    number: dict[str, int] = {}
    parts, owner = [], []
    for i, doc in enumerate(documents):
        for part in doc:
            ids = [number.setdefault(w, len(number) + 1) for w in part]
            parts.append(ids + [0] * (WINDOW - len(ids)))
            owner.append(i)
    numbers, rows, runs = net.vocabulary.rows(list(number))
    parts, owner = np.append(0, numbers)[np.array(parts, np.int64)], np.array(owner)
    truth = np.array(labels, np.float32)[owner]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, chosen = 0, np.arange(len(parts))
    epochs = max(epochs, -(-least_steps * batch // len(parts)))
    for epoch in range(epochs):
        if 3 * epoch >= epochs:  # of a toxic document only windows that look toxic, at least the most toxic one
            score = score_windows(net, rows, runs, parts)
            best = np.zeros(len(documents), np.float32)
            np.maximum.at(best, owner, score)
            chosen = np.flatnonzero((truth == 0) | (score >= np.maximum(0.9, 0.999 * best[owner])) | (score == best[owner]))
        order = rng.permutation(chosen)
        weight = {1: 0.5 / max(1, (truth[chosen] == 1).sum()), 0: 0.5 / max(1, (truth[chosen] == 0).sum())}
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            here, ids = np.unique(parts[pick], return_inverse=True)
            ids = ids.reshape(len(pick), WINDOW)
            if here[0] != 0:
                here, ids = np.append(0, here), ids + 1
            share = np.where(truth[pick] == 1, weight[1], weight[0]) * len(order) / len(pick)
            _, grad = net.gradients(rows[here[1:] - 1], runs[here[1:] - 1], ids, truth[pick], share)
            step += 1
            for k, g in grad.items():
                if k in ("word", "char"):
                    g = g + 1e-5 * net.p[k]
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.p[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
    return net


def score_windows(net: Network, rows: np.ndarray, runs: np.ndarray, parts: np.ndarray, size: int = 2048) -> np.ndarray:
    """Scores of windows; equal windows (most hold unknown words only) are computed once."""
    if not len(parts):
        return np.zeros(0, np.float32)
    gates = net.gates(net.inputs(rows, runs)[0])
    with np.errstate(over="ignore"):
        codes = (parts.astype(np.uint64) * _MIX).sum(1) ^ (parts.astype(np.uint64) * _MIX[::-1]).sum(1) << np.uint64(1)
    _, first, back = np.unique(codes, return_index=True, return_inverse=True)
    out = [net.forward(gates, parts[first[at:at + size]]) for at in range(0, len(first), size)]
    return np.concatenate(out)[back]


def score_texts(net: Network | None, texts: list[str | None]) -> np.ndarray:
    """The greatest window score of each text."""
    best = np.zeros(len(texts))
    if net is None:
        return best
    number: dict[str, int] = {}
    parts, owner = [], []
    for i, text in enumerate(texts):
        ids = [number.setdefault(w, len(number) + 1) for w in words(text)]
        found = windows(ids)
        parts += found
        owner += [i] * len(found)
    if parts:
        numbers, rows, runs = net.vocabulary.rows(list(number))
        np.maximum.at(best, np.array(owner), score_windows(net, rows, runs, np.append(0, numbers)[np.array(parts)]))
    return best


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Network | None:
    """A network for ``labels`` (of which ``usable`` rows may be read); the sample is drawn by a hash of the ids."""
    known = labels.where(usable) if usable is not None else labels
    known = known.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(
        F.max(F.col(label_col)).cast("int").alias("label"))
    draw = lambda kind: known.where(F.col("label") == kind).orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
    chosen = [(r["key"], r["label"]) for kind in (0, 1) for r in draw(kind).collect()]
    if len({label for _, label in chosen}) < 2:
        return None
    spark = docs.sparkSession
    table = spark.createDataFrame(chosen, known.schema)

    @F.pandas_udf("array<string>")
    def cut(texts):
        import pandas as pd

        out = []
        for text in texts:
            found = windows(words(text))
            if len(found) > SAMPLE_WINDOWS:
                found = [found[i * len(found) // SAMPLE_WINDOWS] for i in range(SAMPLE_WINDOWS)]
            out.append([" ".join(w for w in part if w) for part in found])
        storage.release()
        return pd.Series(out, dtype=object)

    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    # the sample has at most twice SAMPLE rows
    picked = texts.join(F.broadcast(table), "key").dropDuplicates(["key"])
    rows = picked.select("key", "label", cut("text").alias("parts")).collect()
    rows = sorted(((r["key"], r["label"], r["parts"]) for r in rows if r["parts"]), key=lambda r: str(r[0]))
    same: dict[str, str] = {}
    documents = [[[same.setdefault(w, w) for w in part.split(" ")] for part in r[2]] for r in rows]
    return train(documents, [r[1] for r in rows])


def score(docs: DataFrame, net: Network | None, column: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` and a ``column`` of scores from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(net)  # bounded by MOST_WORDS and MOST_GRAMS

    @F.pandas_udf("double")
    def run(texts):
        import pandas as pd

        storage.let_go()
        parts = [score_texts(sent.value, texts.iloc[at:at + BATCH].tolist()) for at in range(0, len(texts), BATCH)]
        storage.release()
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return docs.withColumn(column, run(F.col(text_col).cast("string")))


def keep_clean(docs: DataFrame, net: Network | None, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score under ``threshold``, with their columns as they were."""
    mark = "score"
    while mark in docs.columns:
        mark += "_"
    return score(docs, net, mark, text_col).where(F.col(mark) < threshold).drop(mark)
