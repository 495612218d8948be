"""Helpers shared by the operators: written tables, folds, links to components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_engine.session import new_workspace, remove_folders


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` within go when the block has ended well, save lasting ones.

    So only what is written as lasting may be read afterwards. After an error
    the folders stay, as for any other job that was cut short.
    """
    outer, made = _PASSING.get(), []
    _PASSING.set(made)
    try:
        yield
    finally:
        _PASSING.set(outer)
    remove_folders(spark, *made)


def written(df: DataFrame, label: str, lasting: bool = False, packed: bool = False) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Cuts the lineage: a lost executor costs the tasks that read the table, not
    the work that made it. Within ``passing_tables`` it goes with the others
    unless it is ``lasting``. A table of few long rows that are compressed
    already is ``packed``: every row is a row group, so that readers hold one.
    """
    spark = df.sparkSession
    path = new_workspace(spark, label)
    passing = _PASSING.get()
    if passing is not None and not lasting:
        passing.append(path)
    options = {"compression": "none", "parquet.block.row.count.limit": "1"} if packed else {}
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``function`` over the Arrow batches of ``df``; batches of no rows are skipped."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def portions(batches: Iterable[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows in which ``column`` holds about ``size`` bytes or numbers, so that tasks hold little; rows stay whole."""
    for batch in batches:
        values = batch.column(column)
        lengths = values.value_lengths() if pa.types.is_list(values.type) else pa.compute.binary_length(values)
        part = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)
        give_back()


def give_back() -> None:
    """Free memory goes back to the system: workers are used again, by stages that need little too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def spanning_links(size: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, member) links that join the same of ``size`` nodes as the pairs given, one for each node not a root."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        now = label.copy()
        np.minimum.at(now, label[left], low)
        np.minimum.at(now, label[right], low)
        now = now[now]
        if (now == label).all():
            members = np.flatnonzero(label != np.arange(size))
            return label[members], members
        label = now


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component.

    ``links`` has two long columns ``a`` and ``b``. Alternates the large-star
    and small-star steps (Kiveris et al., 2014) until only stars around
    smallest nodes are left. Each step is a grouped minimum with partial
    aggregation and a join; every round is written, so no lineage builds up.
    """
    stars = written(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), label
    )
    while not _only_stars(stars):
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        rest = large.join(low, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        stars = written(low.select(F.col("m").alias("a"), "b").unionAll(rest).distinct(), label)
    return stars.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _only_stars(links: DataFrame) -> bool:
    """Whether every node is either a centre or a member of exactly one centre."""
    ends = links.select(F.col("a").alias("n"), F.lit(0).alias("member"), F.lit(1).alias("centre")).unionAll(
        links.select("b", F.lit(1), F.lit(0))
    )
    roles = ends.groupBy("n").agg(F.sum("member").alias("member"), F.max("centre").alias("centre"))
    return roles.where("member > 1 or (member > 0 and centre > 0)").isEmpty()
