"""Embedding whitening with distributed block matrices.

Entries are first put on a grid of whole numbers, so equal vectors are equal
exactly. The mean and the scatter are taken over the distinct grid vectors:
centred rows are indexed into a ``BlockMatrix`` of Spark MLlib, its transpose
times itself gives the scatter, and only this small square matrix comes to the
driver for its eigenvectors. All rows, repeated ones included, form a second
``BlockMatrix``; its product with the whitening matrix projects them.

The blocks of the long side meet in many partial products that are added up
afterwards, so no task holds the whole matrix. The driver holds a square
matrix of the number of dimensions, whatever the number of rows.

Results:

* rows whose vector is NULL, or holds a NULL or non-finite entry, give
  nothing; entries beyond ``LARGEST`` in size count as not finite, as their
  whole numbers would not be exact;
* the most common length of the other vectors counts (ties: the longer);
  empty vectors and those of other lengths give nothing;
* components follow the falling eigenvalue, up to ``COMPONENTS``; those
  without variance (below 1e-12 of the largest) are left out, so a table of
  equal vectors gives no rows, as does an empty one;
* NULL and repeated ids are rows like others; further columns play no part;
* ``deviation`` is exact while it fits a long, else NULL.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, DenseMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import arrow_map, stored

COMPONENTS = 16
STEPS = 64
SHIFT = 1_000_000
LARGEST = 2.0**40
ROWS_PER_BLOCK = 1024
# Number of a row within its partition, in a monotonically increasing id.
LOW_BITS = (1 << 33) - 1


def on_grid(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the whole numbers of the vectors that take part."""
    entry = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")
    )
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = entry.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(F.coalesce(fine, F.lit(False)))
    x = F.transform("v", lambda c: F.floor(c * STEPS) + F.lit(SHIFT).cast("long"))
    return rows.select("vec_id", x.alias("x"))


def stored_with_index(rows: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """The stored rows with ``i`` from 0 without gaps, and their number.

    The driver sees one count for each written partition.
    """
    kept = stored(rows.withColumn("at", F.monotonically_increasing_id()), purpose)
    part = F.shiftrightunsigned("at", 33)
    counts = sorted(tuple(r) for r in kept.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    begins, total = [], 0
    for p, n in counts:
        begins.append((p, total))
        total += n
    offsets = kept.sparkSession.createDataFrame(begins, "p long, begin long")
    joined = kept.withColumn("p", part).join(F.broadcast(offsets), "p")
    i = F.col("begin") + F.col("at").bitwiseAND(F.lit(LOW_BITS))
    return joined.withColumn("i", i).drop("p", "at", "begin"), total


def sums(rows: DataFrame, dimensions: int) -> np.ndarray:
    """Exact sums of ``x`` by dimension; each batch of rows sends one partial sum."""

    def add(batch):
        flat = batch.column("x").flatten().to_numpy().reshape(-1, dimensions)
        return {"part": [flat.sum(axis=0)]}

    parts = arrow_map(rows.select("x"), add, "part array<long>").select(F.posexplode("part"))
    total = np.zeros(dimensions, dtype=np.int64)
    for r in parts.groupBy("pos").agg(F.sum("col").alias("s")).collect():
        total[r.pos] = r.s
    return total


def literal(values, kind: str) -> Column:
    return F.array(*[F.lit(v.item()) for v in values]).cast(f"array<{kind}>")


def block_matrix(rows: DataFrame, n: int, mean: np.ndarray) -> BlockMatrix:
    """Rows (``i``, ``x``), centred, as blocks of whole rows."""
    centred = F.zip_with(F.col("x").cast("array<double>"), literal(mean, "double"), lambda a, m: a - m)
    vectors = rows.select(F.col("i").alias("index"), array_to_vector(centred).alias("vector"))
    indexed = callMLlibFunc("createIndexedRowMatrix", MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, len(mean))
    return IndexedRowMatrix(indexed).toBlockMatrix(ROWS_PER_BLOCK, len(mean))


def times(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product; with ``splits``, partial products over parts of the inner dimension are added up."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def scatter(matrix: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times matrix, over n, on the driver."""
    blocks = -(-n // ROWS_PER_BLOCK)
    # As many partial sums as there are tasks to make them, with several blocks each.
    splits = max(1, min(blocks, int(np.sqrt(blocks)) * 2))
    return times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray() / n


def local_block(values: np.ndarray, spark) -> BlockMatrix:
    rows, columns = values.shape
    dense = DenseMatrix(rows, columns, values.ravel(order="F").tolist())
    return BlockMatrix(spark.sparkContext.parallelize([((0, 0), dense)], 1), rows, columns)


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row for each remaining vector and component."""
    spark = vectors.sparkSession
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    nothing = spark.createDataFrame([], schema)
    grid = on_grid(vectors, id_column, column)
    lengths = grid.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    if common is None:
        return nothing
    d = common.d
    grid = grid.where(F.size("x") == d)
    rows, n_rows = stored_with_index(grid, "whitening-rows")
    distinct, n = stored_with_index(rows.select("x").distinct(), "whitening-distinct")
    total = sums(distinct, d)
    mean = total / n
    fit = block_matrix(distinct, n, mean)
    values, bases = np.linalg.eigh(scatter(fit, n))
    values, bases = values[::-1], bases[:, ::-1]
    kept = min(components, int((values > max(values[0], 0.0) * 1e-12).sum()))
    if not kept:
        return nothing
    # One sign for all runs: the largest entry of each component is positive.
    largest = bases[np.abs(bases).argmax(axis=0), np.arange(d)]
    white = (bases * np.where(largest < 0, -1.0, 1.0) / np.sqrt(np.maximum(values, 1e-300)))[:, :kept]
    white_block = local_block(white, spark)
    error = float(np.abs(scatter(times(fit, white_block), n) - np.eye(kept)).max())
    explained = literal(values[:kept] / values.sum(), "double")

    projected = times(block_matrix(rows, n_rows, mean), white_block).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    found = MLUtils.convertVectorColumnsToML(found, "vector")
    found = found.select(F.col("index").alias("i"), vector_to_array("vector").alias("w"))
    # d * d as a decimal, so that one too large for a long is NULL instead of an error.
    off = F.zip_with("x", literal(total, "long"), lambda a, s: (a * n - s).cast("decimal(19,0)"))
    squares = F.aggregate(off, F.lit(0).cast("decimal(38,0)"), lambda s, o: (s + o * o).cast("decimal(38,0)"))
    deviation = F.expr("try_cast(squares as bigint)")
    return (
        rows.join(found, "i")
        .withColumn("squares", squares)
        .select("vec_id", deviation.alias("deviation"), F.posexplode("w").alias("k", "whitened"))
        .select(
            "vec_id",
            (F.col("k") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("k")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
