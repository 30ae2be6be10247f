"""Embedding whitening on Spark MLlib's distributed block matrices.

Vectors become integers; the fit list is each distinct integer vector once. Its rows, centred by exact integer sums,
are cut into blocks of ``block_rows`` rows by the tasks that hold them (the last block of a task is filled up with zero
rows, which add nothing), so a block matrix needs no shuffle to be made. A transposed block matrix times itself
gives the scatter; its eigenvectors are found on the driver (the matrix has the vectors' length on both sides); a
block matrix times the whitening matrix projects all rows. Block matrices keep the places of their blocks on the driver,
so rows are taken in slabs of at most ``SLAB`` blocks, whose scatters add up.

Defined results: vectors that are null, empty or hold null, non-finite or too large entries (beyond 2**52 after
scaling) take no part; vectors of different lengths are whitened apart, each length with a fit list of its own;
components whose variance is zero in double precision are left out, so a fit list of one vector gives no rows; rows
with null or repeated ids stay rows of their own; ties between eigenvalues leave any orthonormal choice; a
deviation beyond 64 bits is null; an empty table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm import storage

#: Rows of a block, blocks of a slab, columns of a block.
BLOCK_ROWS, SLAB, BLOCK_COLS = 4096, 16_384, 1024
_MATRIX = ("struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,values:array<double>,"
           "isTransposed:boolean>")
_INDEX = T.StructType([T.StructField("r", T.LongType()), T.StructField("c", T.LongType())])
_BLOCKS = T.StructType([T.StructField("place", _INDEX), T.StructField("matrix", MatrixUDT())])


def integers(vectors: DataFrame, scale: int, shift: int, id_col: str, vector_col: str) -> DataFrame:
    """``row, id, x``: a number for each row that takes part, its id and its integer vector."""
    value = lambda c: F.floor(c.cast("double") * scale)
    good = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double") * scale) <= 2.0 ** 52)
    known = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(
        (F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(good(c), F.lit(False))))
    x = F.transform("v", lambda c: value(c).cast("bigint") + F.lit(shift).cast("bigint"))
    return known.select(F.monotonically_increasing_id().alias("row"), "id", x.alias("x"))


def _centre(batch: pa.RecordBatch, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """Centred rows, and the exact sums of ``(n * x - S) ** 2``."""
    size = len(sums)
    x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if most < 1 << 62:
        far = n * x - np.array(sums, np.int64)
        largest = int(np.abs(far).max(initial=0))
        if size * largest * largest < 1 << 63:
            return far / n, (far * far).sum(1).tolist()
    far = [[n * v - s for v, s in zip(row, sums)] for row in x.tolist()]
    exact = [sum(v * v for v in row) for row in far]
    return (np.array([[v / n for v in row] for row in far], float).reshape(-1, size),
            [v if v < 1 << 63 else None for v in exact])


def _matrix(values: np.ndarray) -> dict:
    rows, columns = values.shape
    return {"type": 1, "numRows": rows, "numCols": columns, "colPtrs": None, "rowIndices": None,
            "values": values.ravel(), "isTransposed": True}


def blocks(rows: DataFrame, n: int, sums: list[int], block_rows: int, name: str) -> DataFrame:
    """``block, ids, deviations, column, matrix``: centred rows in blocks numbered from 0, cut by columns as well."""
    spark = rows.sparkSession
    id_type = rows.schema["id"].dataType.simpleString()
    kinds = pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
                       ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])

    def cut(batches):
        held, count = [], 0

        def full(batch):
            centred, far = _centre(batch, n, sums)
            whole = np.zeros((block_rows, len(sums)))
            whole[:len(centred)] = centred
            for at in range(0, len(sums), BLOCK_COLS):
                first = at == 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch["id"].to_pylist() if first else None], pa.list_(batch["id"].type)),
                     pa.array([far if first else None], pa.list_(pa.int64())), pa.array([at // BLOCK_COLS], pa.int64()),
                     pa.array([_matrix(whole[:, at:at + BLOCK_COLS])], kinds)], ["ids", "deviations", "col", "matrix"])

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            while count >= block_rows:
                table = pa.Table.from_batches(held).combine_chunks()
                yield from full(table.slice(0, block_rows).combine_chunks().to_batches()[0])
                held, count = table.slice(block_rows).to_batches(), count - block_rows
        if count:
            yield from full(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    made = rows.select("id", "x").mapInArrow(cut, f"ids array<{id_type}>, deviations array<bigint>, col bigint, matrix {_MATRIX}")
    numbered = F.monotonically_increasing_id()
    wide = -(-len(sums) // BLOCK_COLS)
    kept = storage.written(made.select(F.spark_partition_id().alias("part"), F.bitwise_not(
        F.lit((1 << 33) - 1)).bitwiseAND(numbered).alias("base"), numbered.alias("at"), "*").select(
            "part", ((F.col("at") - F.col("base")) / wide).cast("bigint").alias("nth"), "ids", "deviations", "col", "matrix"), name)
    # one row a task that made blocks
    before, start = [], 0
    for part, count in sorted(map(tuple, kept.groupBy("part").agg((F.max("nth") + 1).alias("n")).collect())):
        before.append((part, start))
        start += count
    table = spark.createDataFrame(before, "part int, start bigint")
    return kept.join(F.broadcast(table), "part").select(
        (F.col("start") + F.col("nth")).alias("block"), "ids", "deviations", "col", "matrix")


def block_matrix(table: DataFrame, block_rows: int, block_cols: int, count: int, columns: int) -> BlockMatrix:
    """A distributed matrix of written blocks (``place``, ``matrix``)."""
    made = callMLlibFunc("createBlockMatrix", table, block_rows, block_cols, count * block_rows, columns)
    return BlockMatrix(made, block_rows, block_cols)


def _placed(table: DataFrame, low: int, high: int, name: str) -> DataFrame:
    """Blocks from ``low`` on and below ``high``, written with the places and types that a block matrix takes."""
    some = table.where((F.col("block") >= low) & (F.col("block") < high)).select(
        F.struct((F.col("block") - low).alias("r"), F.col("col").alias("c")).alias("place"), "matrix")
    return some.sparkSession.read.schema(_BLOCKS).parquet(storage.written_path(some, name))


def times(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product; its inner dimension is dealt to ``splits`` tasks for each block of the result."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def _result(matrix: BlockMatrix) -> DataFrame:
    """``place, matrix`` of a block matrix as a table."""
    return callMLlibFunc("getMatrixBlocks", matrix._java_matrix_wrapper._java_model).toDF("place", "matrix")


def slabs(table: DataFrame, name: str, block_rows: int, columns: int):
    """Block matrices of at most ``SLAB`` row blocks each: (first block, matrix)."""
    count = (table.agg(F.max("block")).first()[0] or 0) + 1 if not table.isEmpty() else 0
    for low in range(0, count, SLAB):
        high = min(count, low + SLAB)
        placed = _placed(table, low, high, name)
        yield low, high - low, block_matrix(placed, block_rows, min(columns, BLOCK_COLS), high - low, columns)


def scatter(table: DataFrame, block_rows: int, columns: int, name: str) -> np.ndarray:
    """The sum of the outer products of all rows."""
    out = np.zeros((columns, columns))
    for _, count, matrix in slabs(table, name, block_rows, columns):
        splits = min(count, storage.shards(table.sparkSession))
        out += times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()
    return out


def _values(matrix: dict) -> np.ndarray:
    shape = (matrix["numRows"], matrix["numCols"])
    values = np.asarray(matrix["values"])
    return values.reshape(shape) if matrix["isTransposed"] else values.reshape(shape[::-1]).T


def project(table: DataFrame, weights: np.ndarray, block_rows: int, name: str) -> DataFrame:
    """``block, col, matrix``: all blocks times ``weights``."""
    spark = table.sparkSession
    columns, kept = weights.shape
    wide = min(columns, BLOCK_COLS)
    parts = [((at // wide, 0), DenseMatrix(len(weights[at:at + wide]), kept, weights[at:at + wide].T.ravel()))
             for at in range(0, columns, wide)]
    right = BlockMatrix(spark.sparkContext.parallelize(parts, 1), wide, kept, columns, kept)
    out = []
    for low, _, matrix in slabs(table, f"{name}-in", block_rows, columns):
        product = _result(times(matrix, right)).select(
            (F.col("place").getField("_1") + low).alias("block"), F.lit(0).cast("bigint").alias("col"), "matrix")
        path = storage.written_path(product, f"{name}-out")
        out.append(spark.read.schema(f"block bigint, col bigint, matrix {_MATRIX}").parquet(path))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], f"block bigint, col bigint, matrix {_MATRIX}")


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id",
           vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component."""
    spark = vectors.sparkSession
    storage.ship_package(spark)
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = storage.written(integers(vectors, scale, shift, id_col, vector_col), "integer-vectors")
    lengths = [r[0] for r in rows.groupBy(F.size("x").alias("d")).count().orderBy("d").collect()]
    out = [_whiten_length(rows.where(F.size("x") == d), d, components, block_rows, schema) for d in lengths]
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema)


def _whiten_length(rows: DataFrame, size: int, components: int, block_rows: int, schema: str) -> DataFrame:
    spark = rows.sparkSession
    # copies are combined before the shuffle; the first of them stands for its vector
    fit = storage.written(rows.groupBy("x").agg(F.min("row").alias("row"), F.min_by("id", "row").alias("id")), "fit-list")
    later = rows.join(fit.select("row"), "row", "left_anti")
    sums = fit.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(size)]).first()
    n, sums = int(sums["n"]), [int(sums[f"s{i}"]) for i in range(size)]
    fit_blocks = blocks(fit, n, sums, block_rows, "fit-blocks")
    later_blocks = blocks(later, n, sums, block_rows, "later-blocks")
    covariance = scatter(fit_blocks, block_rows, size, "fit-places") / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, int((values > max(values[0], 0) * size * np.finfo(float).eps).sum()))
    if not kept:
        return spark.createDataFrame([], schema)
    weights = axes[:, :kept] / np.sqrt(values[:kept])
    explained = (values[:kept] / values.clip(0).sum()).tolist()
    fit_white = project(fit_blocks, weights, block_rows, "fit-white")
    # the columns are sums of centred ones, and so are centred themselves
    error = float(np.abs(scatter(fit_white, block_rows, kept, "white-places") / n - np.eye(kept)).max())

    def flat(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, white = row["ids"], _values(row["matrix"])
                for at in range(0, len(ids), 4096):
                    part = pa.array(ids[at:at + 4096], batch.schema.field("ids").type.value_type)
                    some, each = len(part), np.repeat(np.arange(len(part)), kept)
                    yield pa.RecordBatch.from_arrays(
                        [part.take(pa.array(each)), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), some)),
                         pa.array(np.full(some * kept, n)),
                         pa.array(row["deviations"][at:at + 4096], pa.int64()).take(pa.array(each)),
                         pa.array(white[at:at + some].ravel()), pa.array(np.tile(explained, some)),
                         pa.array(np.full(some * kept, error))],
                        ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    def result(table, white):
        named = table.where(F.col("col") == 0).select("block", "ids", "deviations")
        return named.join(white.select("block", "matrix"), "block").select("ids", "deviations", "matrix").mapInArrow(flat, schema)

    out = result(fit_blocks, fit_white)
    if later_blocks.isEmpty():
        return out
    return out.unionByName(result(later_blocks, project(later_blocks, weights, block_rows, "later-white")))
