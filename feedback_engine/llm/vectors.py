"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Different vectors are dealt into blocks, and every pair of blocks is one task's
work. A task quantises its vectors to int8 and multiplies tiles of them, exactly
in whole numbers. What quantising took off a vector has a norm, and the two
norms bound how far the product is from the cosine. Pairs that are surely above
the threshold link, pairs that are surely below do not, and only those in
between are computed again in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedback_engine.llm.common import components, spanning_links, written

LEAST = 0.95
BLOCK = 8192  # expected vectors in a block; a task holds two
TILE = 512
# Allowance for rounding in the bounds themselves and in norms.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector is neither null nor zero, and all of its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Quantised:
    """Unit vectors, their int8 codes and bounds."""

    def __init__(self, rows: np.ndarray) -> None:
        rows = rows / np.abs(rows).max(axis=1, keepdims=True)
        self.unit = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        self.step = np.abs(self.unit).max(axis=1) / 127
        codes = np.rint(self.unit / self.step[:, None])
        coded = codes * self.step[:, None]
        self.lost = np.sqrt(((self.unit - coded) ** 2).sum(axis=1)) + SLACK
        self.kept = np.sqrt((coded**2).sum(axis=1)) + SLACK
        # Products of int8 codes are whole numbers that single precision holds exactly up to this dimension.
        self.codes = codes.astype(np.int8)
        self.exact = np.float32 if rows.shape[1] * 127 * 127 < 2**24 else np.float64


def linked_pairs(a: Quantised, b: Quantised, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs whose cosine is ``least`` or more."""
    right = b.codes.astype(a.exact).T
    rows, columns = [], []
    for at in range(0, len(a.unit), TILE):
        tile = slice(at, at + TILE)
        product = a.codes[tile].astype(a.exact) @ right
        # The largest error of a row against any column rules out most pairs in one comparison.
        worst = a.lost[tile] * (b.kept.max() + b.lost.max()) + a.kept[tile] * b.lost.max()
        product *= b.step.astype(a.exact)
        bound = ((least - worst) / a.step[tile] * (1 - 1e-6) - 1e-6).astype(a.exact)
        i, j = np.nonzero(product >= bound[:, None])
        if not len(i):
            continue
        whole = (a.codes[tile][i].astype(np.int32) * b.codes[j]).sum(axis=1, dtype=np.int64)
        i = i + at
        near = whole * a.step[i] * b.step[j]
        error = a.lost[i] * (b.kept[j] + b.lost[j]) + a.kept[i] * b.lost[j] + SLACK
        open_ = np.flatnonzero((near + error >= least) & (near - error < least))
        linked = near - error >= least
        linked[open_] = (a.unit[i[open_]] * b.unit[j[open_]]).sum(axis=1) >= least
        rows.append(i[linked])
        columns.append(j[linked])
    none = np.empty(0, np.int64)
    return np.concatenate(rows or [none]), np.concatenate(columns or [none])


def _joiner(least: float):
    def run(table: pa.Table) -> pa.Table:
        """Links of one pair of blocks: a weight for each vector, and links that join what is connected."""
        ids, weights, first, second = (
            table[name].to_numpy() for name in ("node", "n", "first", "second")
        )
        rows = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        rows = rows.reshape(len(ids), -1).astype(np.float64)
        own = table["block"].to_numpy()
        left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)
        quantised = Quantised(rows[left])
        if first[0] == second[0]:
            i, j = _each_pair_once(quantised, least)
        else:
            if not (len(left) and len(right)):
                return NOTHING
            i, j = linked_pairs(quantised, Quantised(rows[right]), least)
        i, j = left[i], right[j]
        if not len(i):
            return NOTHING
        sums = np.bincount(i, weights[j], len(ids)) + np.bincount(j, weights[i], len(ids))
        some = np.flatnonzero(sums)
        root, member = spanning_links(len(ids), i, j)
        none = pa.nulls(len(some), pa.int64())
        return pa.table(
            {
                "a": np.concatenate((ids[some], ids[root])),
                "b": pa.chunked_array([none, pa.array(ids[member], pa.int64())]),
                "n": np.concatenate((sums[some].astype(np.int64), np.zeros(len(root), np.int64))),
            }
        )

    return run


def _each_pair_once(block: Quantised, least: float) -> tuple[np.ndarray, np.ndarray]:
    i, j = linked_pairs(block, block, least)
    return i[i < j], j[i < j]


NOTHING = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})


def vector_links(vectors: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id reachable. Rows whose vector is not ``usable``, or that have no
    id, link with nothing; without an id the component is null and the row is
    not kept. Vectors of different dimensions never link. Rows with equal
    vectors are linked to each other and compared once; repeated rows count as
    rows, and rows of one id with different vectors are vectors of their own.
    Further columns are not read.
    """
    given = vectors.select("vec_id", "embedding")
    # Equal vectors by two 64-bit hashes.
    key = F.struct(F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding"))
    rows = given.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).withColumn("key", key)
    groups = rows.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    # Numbers hold from here on, as the table is written: a vector is a node, whatever ids its rows have.
    groups = written(groups.withColumn("node", F.monotonically_increasing_id()), "vector_groups")
    distinct = rows.join(groups, "key").where("vec_id = rep").dropDuplicates(["node"])
    distinct = written(distinct.select("node", "n", "embedding", F.size("embedding").alias("size")), "vectors")
    blocks = max(1, -(-distinct.count() // block))
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    own = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    pairs = distinct.withColumn("block", own).withColumn("other", F.explode(others))
    pairs = pairs.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")}).drop("other")
    made = pairs.groupBy("size", "first", "second").applyInArrow(_joiner(least), "a long, b long, n long")
    made = written(made, "vector_links")
    counts = made.where("b is null").groupBy("a").agg(F.sum("n").alias("found"))
    roots = components(made.where("b is not null").select("a", "b"), "vector_components")
    by_node = (
        groups.join(counts, groups["node"] == counts["a"], "left")
        .join(roots.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
        .select("key", "rep", F.coalesce("root", "node").alias("root"), (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    smallest = by_node.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_group = by_node.join(smallest, "root").select("key", "n_links", "component_id")
    linked = rows.select("vec_id", "key").join(by_group, "key").drop("key")
    alone = given.where(~usable(F.col("embedding")) | F.col("vec_id").isNull())
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
