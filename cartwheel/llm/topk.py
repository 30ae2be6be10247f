"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are integers ``floor(scale * x)``. Cut into segments, two vectors' squared distance is at least the
sum over segments of ``length * ((mean - mean')^2 + (deviation - deviation')^2)``; with the norms known that bounds their
inner product from above. Bounds go from coarse to fine; a pair is dropped once its bound is under the score
that the query is sure to reach, and the survivors' products are computed exactly.

Queries are taken in blocks of ``block`` rows. A block, bounded by its row count and the vectors' length, is sent to
the tasks; each task scans its vectors once, batch by batch, and gives at most ``k`` rows for a query. Sure scores
start from the block's own rows, so distant partitions send almost nothing.

Defined results: rows with a null id, a null or empty vector, or null or non-finite components take no part; vectors of
another length than the query's are no candidates of it; every row with a query's id is its own; of repeated query
ids the vector least in order asks; repeated candidates all count, ties go to the smaller id;
an empty table gives an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm import storage
from cartwheel.session import scratch_path

LEVELS = (2, 8, 16)
SLACK = 1e-6  # bounds are computed in floating point; this share of the norms keeps them on the safe side


def whole(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``id, v``: rows that take part, with integer components."""
    v = F.col(vector_col)
    good = (F.col(id_col).isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    return vectors.where(good).select(F.col(id_col).cast("bigint").alias("id"), F.transform(
        v, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"))


def segment_stats(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments of each row, times the root of the segment's length."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    sizes = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / sizes
    square = np.add.reduceat(x * x, edges[:-1], axis=1) / sizes
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean, deviation], 1) * np.sqrt(np.concatenate([sizes, sizes]))


class Queries:
    """One block's vectors of one length, their statistics by level, and their sure scores."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x.astype(float), k
        self.norm = (self.x ** 2).sum(1)
        self.stats = [segment_stats(self.x, n) for n in LEVELS]
        scores = self.x @ self.x.T
        scores[ids[:, None] == ids[None, :]] = -np.inf
        if len(ids) > k:
            self.sure = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        else:
            self.sure = np.full(len(ids), -np.inf)

    def search(self, ids: np.ndarray, x: np.ndarray):
        """(query's place, candidate's place, score) of at most ``k`` candidates of each query."""
        x = x.astype(float)
        norm = (x ** 2).sum(1)
        q, c = None, None
        slack = SLACK * (1 + self.norm[:, None] + norm[None, :])
        for level, (stats, segments) in enumerate(zip(self.stats, LEVELS)):
            mine = segment_stats(x, segments)
            # the distance bound turned into a bound of the product: (|q|^2 + |c|^2 - d^2) / 2 = stats . stats'
            if level == 0:
                bound = stats @ mine.T + slack
                q, c = np.nonzero((bound >= self.sure[:, None]) & (self.ids[:, None] != ids[None, :]))
            elif len(q) > 0.2 * len(self.ids) * len(ids):  # too many left to look at one by one
                bound = stats @ mine.T + slack
                keep = bound[q, c] >= self.sure[q]
                q, c = q[keep], c[keep]
            else:
                keep = np.einsum("ij,ij->i", stats[q], mine[c]) + slack[q, c] >= self.sure[q]
                q, c = q[keep], c[keep]
        if len(q) > 0.2 * len(self.ids) * len(ids):
            score = (self.x @ x.T)[q, c]
        else:
            score = np.concatenate([np.einsum("ij,ij->i", self.x[q[i:i + 65536]], x[c[i:i + 65536]])
                                    for i in range(0, len(q), 65536)]) if len(q) else np.zeros(0)
        order = np.lexsort((ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        starts = np.searchsorted(q, np.arange(len(self.ids)))
        nth = np.arange(len(q)) - starts[q]
        keep = (nth < self.k) & (score >= self.sure[q])
        return q[keep], c[keep], score[keep]

    def raise_sure(self, q: np.ndarray, score: np.ndarray) -> None:
        """A batch that gave a query ``k`` rows makes the least of them sure."""
        count = np.bincount(q, minlength=len(self.ids))
        least = np.full(len(self.ids), np.inf)
        np.minimum.at(least, q, score)
        full = count >= self.k
        self.sure[full] = np.maximum(self.sure[full], least[full])


def _by_length(vectors) -> dict[int, np.ndarray]:
    sizes = np.array([len(v) for v in vectors])
    return {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
            vector_col: str = "embedding", block: int = 2048, rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every row that ``is_query``."""
    spark = vectors.sparkSession
    table = storage.written(whole(vectors, scale, id_col, vector_col), "vectors")
    asking = storage.written(whole(vectors.where(is_query), scale, id_col, vector_col).groupBy("id").agg(
        F.min("v").alias("v")), "queries")
    blocks = max(1, -(-asking.count() // block))
    dealt = F.pmod(F.xxhash64("id"), F.lit(blocks))
    path, schema = scratch_path(spark, "found"), "query_id bigint, vec_id bigint, score bigint"
    for i in range(blocks):
        # about `block` rows: ids are dealt by their hash
        mine = sorted((r["id"], r["v"]) for r in asking.where(dealt == i).collect())
        groups = _by_length([v for _, v in mine])
        queries = spark.sparkContext.broadcast([Queries(
            np.array([mine[j][0] for j in at]), np.array([mine[j][1] for j in at], float), k) for at in groups.values()])

        def scan(batches, queries=queries):
            sets = {q.x.shape[1]: q for q in queries.value}
            sure = {n: q.sure.copy() for n, q in sets.items()}
            for whole_batch in batches:
                for at in range(0, whole_batch.num_rows, rows):
                    batch = whole_batch.slice(at, rows)
                    ids = batch["id"].to_numpy()
                    column = batch["v"]
                    flat, sizes = column.flatten().to_numpy(), column.value_lengths().to_numpy()
                    starts = np.cumsum(sizes) - sizes
                    for n in np.unique(sizes):
                        if int(n) not in sets:
                            continue
                        some = np.flatnonzero(sizes == n)
                        x = flat[starts[some][:, None] + np.arange(n)]
                        q, c, score = sets[int(n)].search(ids[some], x)
                        sets[int(n)].raise_sure(q, score)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(sets[int(n)].ids[q]), pa.array(ids[some][c]), pa.array(score.astype(np.int64))],
                            ["query_id", "vec_id", "score"])
            for n, kept in sure.items():  # the broadcast value serves other tasks of this worker
                sets[n].sure = kept

        table.mapInArrow(scan, schema).write.parquet(f"{path}/block={i}")
    found = spark.read.schema(schema).parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
