"""Whitening of vectors with Spark MLlib's BlockMatrix.

Entries become whole numbers, ``x = floor(256 * c)``. The distinct x-vectors are
the fit list. Its rows, centred and indexed, are put into a BlockMatrix; the
transpose times the matrix is the scatter, whose middle dimension is split so
that blocks of rows are multiplied in as many tasks as there are groups of them.
The d x d result is decomposed on the driver; the matrix times the whitening
matrix projects all rows of the fit list. Every row of the input gets the
projection of its x-vector by a join on a 128-bit hash of it.

Rows whose vector is null or empty, or holds a null or non-finite entry or one
whose 256-fold is no long, are left out. Vectors of different dimensions do not
mix: each dimension is fitted on its own. Rows that repeat an id or a vector
come back like any other. A component without variance (one fitted vector, or
fewer independent ones than components) has ``whitened`` null, ``explained``
zero (null if no component has variance), and no part in ``identity_error``; an
empty table gives no rows. A ``deviation`` beyond a long is null.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_engine.llm.common import written

SCALE = 256
# Numbers in a block of the matrix: rows of a block are this over the dimension, so blocks of any dimension take 2 MB.
BLOCK_NUMBERS = 1 << 18
# Blocks that one task multiplies in the transpose-multiply.
BLOCKS_A_TASK = 16
# An eigenvalue this small beside the largest is rounding.
RANK_TOLERANCE = 1e-12


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x, k1, k2): the x-vector of each row that takes part, and its hash."""
    entries = F.transform(vector_col, lambda c: SCALE * c.cast("double"))
    # A null comparison (null vector or entry) keeps no row; NaN is greater than any number.
    usable = F.forall("v", lambda c: F.coalesce((c >= F.lit(-(2.0**63))) & (c < F.lit(2.0**63)), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), entries.alias("v")).where(usable & (F.size("v") > 0))
    rows = rows.select("id", F.transform("v", lambda c: F.floor(c)).alias("x"))
    return rows.select("id", "x", F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(1), "x").alias("k2"))


def whiten(
    vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(``id_col``, dimension, n, deviation, whitened, explained, identity_error) of every row that takes part.

    ``whitened`` and ``explained`` are arrays by component, of ``components``
    entries or the dimension, if that is less.
    """
    rows = whole_numbers(vectors, id_col, vector_col)
    # The first of equal vectors: which one makes no difference.
    fit = rows.groupBy("k1", "k2").agg(F.first("x").alias("x"))
    fit = written(fit.select("k1", "k2", "x", F.size("x").alias("d")), "whitening-fit")
    made = None
    for d, n in sorted(fit.groupBy("d").count().collect()):
        one = _whitened(rows.where(F.size("x") == d), fit.where(F.col("d") == d).drop("d"), d, n, components)
        made = one if made is None else made.unionAll(one)
    if made is None:
        made = rows.where("false").select(
            "id", F.lit(0).alias("dimension"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            F.array(F.lit(0.0)).alias("whitened"), F.array(F.lit(0.0)).alias("explained"), F.lit(0.0).alias("identity_error"),
        )
    return made.withColumnRenamed("id", id_col)


def _whitened(rows: DataFrame, fit: DataFrame, d: int, n: int, components: int) -> DataFrame:
    spark = fit.sparkSession
    sums = fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"))
    total = [int(s) for _, s in sorted(sums.collect())]  # d numbers
    mean = F.array(*[F.lit(s / n) for s in total])
    centred = F.zip_with("x", mean, lambda c, m: c.cast("double") - m)
    indexed = written(_indexed(fit).select("index", "k1", "k2", centred.alias("v")), "whitening-rows")

    matrix = _block_matrix(indexed, n, d)
    scatter = _scatter(matrix, n, d) / n
    values, axes = np.linalg.eigh((scatter + scatter.T) / 2)
    kept = min(components, d)
    values, axes = values[::-1][:kept], axes[:, ::-1][:, :kept]
    rank = int((values > max(values[0], 0) * RANK_TOLERANCE).sum()) if values[0] > 0 else 0
    trace = float(np.trace(scatter))
    explained = [float(v) / trace if k < rank else (0.0 if trace > 0 else None) for k, v in enumerate(values)]

    nothing = F.array(*[F.lit(None).cast("double")] * kept)
    if rank:
        whitening = axes[:, :rank] / np.sqrt(values[:rank])
        # The few columns stand in one column of blocks, beside as many rows of blocks as the matrix has columns of them.
        right = spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, rank, whitening.ravel("F").tolist()))], 1)
        projected = matrix.multiply(BlockMatrix(right, d, rank, d, rank)).toIndexedRowMatrix()
        projected = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
        projected = projected.select("index", vector_to_array("vector").alias("w")).join(
            indexed.select("index", "k1", "k2"), "index"
        )
        projected = written(projected.select("k1", "k2", "w"), "whitening-projected")
        error = F.lit(_identity_error(projected, rank, n))
        full = F.concat("w", F.slice(nothing, 1, kept - rank))
        projected = projected.select("k1", "k2", full.alias("whitened"))
    else:
        error = F.lit(None).cast("double")
        projected = fit.select("k1", "k2", nothing.alias("whitened"))
    return (
        rows.select("id", "k1", "k2", _deviation(n, total).alias("deviation"))
        .join(projected, ["k1", "k2"])
        .select(
            "id", F.lit(d).alias("dimension"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
            F.array(*[F.lit(e).cast("double") for e in explained]).alias("explained"), error.alias("identity_error"),
        )
    )


def _indexed(fit: DataFrame) -> DataFrame:
    """``fit``, a written table, with ``index`` from 0 without gaps: rows count on from one partition to the next."""
    places = fit.select("*", F.monotonically_increasing_id().alias("place"))
    places = places.select("*", F.shiftright("place", 33).cast("int").alias("part"))
    counts = dict(places.groupBy("part").count().collect())  # a number for each partition
    before, starts = 0, []
    for part in range(max(counts) + 1):
        starts.append(before)
        before += counts.get(part, 0)
    start = F.element_at(F.array(*map(F.lit, starts)), F.col("part") + 1)
    return places.select(
        (start + F.col("place").bitwiseAND((1 << 33) - 1)).cast("long").alias("index"), *fit.columns
    )


def _block_matrix(indexed: DataFrame, n: int, d: int) -> BlockMatrix:
    vectors = indexed.select("index", array_to_vector("v").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, d)
    return matrix.toBlockMatrix(max(1, BLOCK_NUMBERS // d), d)


def _scatter(matrix: BlockMatrix, n: int, d: int) -> np.ndarray:
    """The transpose times the matrix. The Python class has no argument for the splits, the class behind it has."""
    splits = max(1, -(-n // (matrix.rowsPerBlock * BLOCKS_A_TASK)))
    java = matrix.transpose()._java_matrix_wrapper
    product = java.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    local: DenseMatrix = BlockMatrix(product, d, d).toLocalMatrix()
    return local.toArray()


def _identity_error(projected: DataFrame, rank: int, n: int) -> float:
    """The largest absolute entry of the covariance of ``w`` minus the identity."""
    at = range(rank)
    means = [F.sum(F.col("w")[i]).alias(f"m{i}") for i in at]
    first = projected.agg(*means).first()
    mean = [first[i] / n for i in at]
    pairs = [(i, j) for i in at for j in at if i <= j]
    products = [F.sum((F.col("w")[i] - mean[i]) * (F.col("w")[j] - mean[j])).alias(f"c{i}_{j}") for i, j in pairs]
    sums = projected.agg(*products).first()
    return max(abs(sums[k] / n - (i == j)) for k, (i, j) in enumerate(pairs))


def _deviation(n: int, total: list[int]) -> Column:
    """The sum of ``(n * x - S) ** 2`` over the dimensions, exact; null if it is no long."""
    limit = 2**63
    if n >= limit or any(not -limit <= s < limit for s in total):
        return F.lit(None).cast("long")
    sums = F.array(*[F.lit(s).cast("long") for s in total])
    distance = F.zip_with("x", sums, lambda c, s: F.try_subtract(F.try_multiply(c, F.lit(n).cast("long")), s))
    return F.aggregate(distance, F.lit(0).cast("long"), lambda a, c: F.try_add(a, F.try_multiply(c, c)))


def by_component(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row for each component, numbered from 1."""
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "x")
    return whitened.select(id_col, "n", "deviation", "identity_error", each).select(
        id_col,
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("x.whitened").alias("whitened"),
        F.col("x.explained").alias("explained"),
        "identity_error",
    )
