"""Benchmark decontamination with a generalised suffix automaton over normalised item words.

The automaton holds every run of words of every item of a block. Document words stream through it; at
each word the longest match that ends there is known, and a window of an item occurs wherever that match is
at least the window's length. Words that no item has, and neighbours that stand beside each other in no item,
end any match at length zero or one, so whole batches are cut there first and only the runs between go
through the automaton word by word.

Benchmarks are read in blocks of at most ``block_bytes`` of text; each block's automaton
is bounded by it and sent to the tasks, and what the blocks find in a document is united.

Defined results: null has no words; items without words are no windows; items of fewer words than
the window are one window; repeated items keep their own ids, of repeated ids both texts count;
rows with equal ids are each checked alone; an empty benchmark finds nothing; other columns are ignored
whatever their names, or kept by :func:`clean`.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm import storage
from cartwheel.llm.simhash import LOWER

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BATCH = 400


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().translate(LOWER))


class Automaton:
    """Suffix automaton of several word sequences; states know which items' windows end there."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = []
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            if ids:
                texts.append((name, ids))
        for _, ids in texts:
            self._add(ids)
        self.size = len(self.vocabulary)
        self.pairs = np.unique(np.array(
            [a * self.size + b for _, ids in texts for a, b in zip(ids, ids[1:])], np.int64))
        self.least = min([window, *(len(ids) for _, ids in texts)])
        # by state: {window's length: items}; a full window's state holds its last `window` words
        self.ends: list[dict[int, set[str]] | None] = [None] * len(self.next)
        for name, ids in texts:
            state, matched = 0, 0
            for i, word in enumerate(ids):
                state, matched = self._step(state, matched, word)
                size = min(window, len(ids))
                if i + 1 >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    if self.ends[at] is None:
                        self.ends[at] = {}
                    self.ends[at].setdefault(size, set()).add(name)
        # the nearest state on the way up, itself included, at which a window ends
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.up = [-1] * len(self.next)
        for at in order:
            self.up[at] = at if self.ends[at] else self.up[self.link[at]] if at else -1

    def _add(self, ids: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for word in ids:
            if word in nxt[last]:
                known = nxt[last][word]
                if length[known] == length[last] + 1:
                    last = known
                    continue
                last = self._split(last, word, known)
                continue
            new = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and word not in nxt[at]:
                nxt[at][word] = new
                at = link[at]
            if at >= 0:
                known = nxt[at][word]
                link[new] = known if length[known] == length[at] + 1 else self._split(at, word, known)
            last = new

    def _split(self, at: int, word: int, known: int) -> int:
        """A copy of ``known`` for the strings that end after ``at``."""
        copy = len(self.next)
        self.next.append(dict(self.next[known]))
        self.link.append(self.link[known])
        self.length.append(self.length[at] + 1)
        self.link[known] = copy
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        while word not in self.next[state]:
            if not state:
                return 0, 0
            state = self.link[state]
            matched = self.length[state]
        return self.next[state][word], matched + 1

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of words in which a window may lie: all neighbours also stand side by side in an item."""
        if not len(ids) or not self.size:
            return []
        if self.least == 1:
            starts = np.flatnonzero((ids >= 0) & np.append(True, ids[:-1] < 0))
            stops = np.flatnonzero((ids >= 0) & np.append(ids[1:] < 0, True)) + 1
            return list(zip(starts.tolist(), stops.tolist()))
        both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        key = ids[both] * self.size + ids[both + 1]
        at = np.searchsorted(self.pairs, key)
        good = both[self.pairs[np.minimum(at, len(self.pairs) - 1)] == key] if len(self.pairs) else both[:0]
        if not len(good):
            return []
        new = np.flatnonzero(np.diff(good) > 1) + 1
        starts, stops = good[np.append(0, new)], good[np.append(new - 1, len(good) - 1)] + 2
        keep = stops - starts >= self.least
        return list(zip(starts[keep].tolist(), stops[keep].tolist()))

    def hits(self, ids: list[int], begin: int):
        """(first word, word after the last, items) of every window that occurs in the run ``ids``."""
        state, matched = 0, 0
        for i, word in enumerate(ids):
            state, matched = self._step(state, matched, word)
            at = self.up[state]
            while at > 0:
                for size, names in self.ends[at].items():
                    if size <= matched:
                        yield begin + i + 1 - size, begin + i + 1, names
                at = self.up[self.link[at]]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find(automaton: Automaton, texts: list[str | None]):
    """For each text: number of words, united hit ranges of words, items whose windows occur."""
    code = automaton.vocabulary.get
    ids, begins = [], [0]
    for text in texts:
        ids += [code(w, -1) for w in words(text)]
        ids.append(-1)  # no match crosses texts
        begins.append(len(ids))
    ids = np.array(ids, np.int64)
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    edges = np.array(begins)
    for start, stop in automaton.runs(ids):
        doc = int(np.searchsorted(edges, start, "right")) - 1
        for a, b, names in automaton.hits(ids[start:stop].tolist(), start - begins[doc]):
            spans[doc].append((a, b))
            items[doc] |= names
    return [(begins[i + 1] - begins[i] - 1, united(spans[i]), items[i]) for i in range(len(texts))]


def automata(benchmark: DataFrame, window: int, block_bytes: int, item_col: str, text_col: str) -> list[Broadcast]:
    """One broadcast automaton for each block of items, each block read alone."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    dealt = items.withColumn("deal", F.xxhash64("item", "text"))
    total = dealt.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + int(total) // block_bytes
    out = []
    for i in range(blocks):
        rows = (dealt.where(F.pmod("deal", F.lit(blocks)) == i) if blocks > 1 else dealt).select("item", "text")
        pairs = sorted(((r[0] if r[0] is not None else "", r[1]) for r in rows.collect()), key=lambda r: (r[0], r[1] or ""))
        out.append(spark.sparkContext.broadcast(Automaton(pairs, window)))
    return out


def _spans_function(block: Broadcast):
    @F.pandas_udf("n int, spans array<struct<a:int,b:int>>, items array<string>")
    def spans(texts):
        import pandas as pd

        storage.let_go()
        rows = []
        for at in range(0, len(texts), BATCH):
            rows += find(block.value, texts.iloc[at:at + BATCH].tolist())
        storage.release()
        return pd.DataFrame({
            "n": [r[0] for r in rows], "spans": [[{"a": a, "b": b} for a, b in r[1]] for r in rows],
            "items": [sorted(r[2]) for r in rows]})

    return spans


def match(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", block_bytes: int = 2 << 20, name: str = "found") -> DataFrame:
    """``docs`` and a column ``name``: the words, hit ranges by block, and items of each text."""
    blocks = automata(benchmark, window, block_bytes, item_col, item_text_col)
    text = F.col(text_col).cast("string")
    parts = [_spans_function(b)(text) for b in blocks]
    return docs.withColumn(name, F.array(*parts))


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
           text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` of every row; spans are the hit ranges of words."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = match(rows, benchmark, window, "text", **options).select("doc_id", "found")
    out = found.select("doc_id", F.col("found")[0]["n"].cast("bigint").alias("n_words"), _union("found").alias("spans"),
                       F.array_sort(F.array_distinct(F.flatten("found.items"))).alias("items"))
    return out.withColumn("n_hit", _covered("spans"))


def _union(name: str):
    """The hit ranges of all blocks as disjoint ranges in order."""
    every = F.array_sort(F.flatten(f"{name}.spans"))
    none = F.array().cast("array<struct<a:int,b:int>>")
    last = lambda done: F.element_at(done, -1)
    grown = lambda done, x: F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
        last(done)["a"].alias("a"), F.greatest(last(done)["b"], x["b"]).alias("b"))))
    return F.aggregate(every, none, lambda done, x: F.when(
        (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["b"] >= x["a"]), grown(done, x)).otherwise(
            F.concat(done, F.array(x))))


def _covered(name: str):
    return F.aggregate(name, F.lit(0).cast("bigint"), lambda n, x: n + x["b"] - x["a"])


def digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


_WORDS_OF_TEXT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # the same words before lower-casing


def _without(texts, spans):
    """Texts without their hit words and what stands between them."""
    import pandas as pd

    out = []
    for text, cut in zip(texts, spans):
        if cut is not None and len(cut):
            places = [m.span() for m in _WORDS_OF_TEXT.finditer(text)]
            parts, at = [], 0
            for span in cut:
                parts.append(text[at:places[span["a"]][0]])
                at = places[span["b"] - 1][1]
            text = "".join([*parts, text[at:]])
        out.append(text)
    return pd.Series(out, dtype=object)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, text_col: str = "text",
          **options) -> DataFrame:
    """Rows of ``docs`` with hit spans cut from their texts; rows with more than ``max_coverage`` of
    their words hit go. The other rows and all other columns stay as they are."""
    names = docs.columns
    mark = "found"
    while mark in names:
        mark += "_"
    found = match(docs, benchmark, window, text_col, name=mark, **options)
    spans = f"{mark}_spans"
    found = found.withColumn(spans, _union(mark))
    kept = found.where(_covered(spans) <= max_coverage * F.greatest(F.col(mark)[0]["n"], F.lit(1)))
    # written once, so that only the few texts with hits are cut, by a worker that no longer holds the automata
    kept = storage.written(kept.drop(mark), "decontaminated")
    hit = F.size(spans) > 0
    cut = F.pandas_udf(_without, "string")(F.col(text_col).cast("string"), F.col(spans))
    return kept.where(~hit).select(*names).unionAll(
        kept.where(hit).select(*[cut.alias(c) if c == text_col else F.col(c) for c in names]))
