"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected ``target / size of the source`` times.
Running sums of that, shifted by one random offset for the source, cross whole
numbers; a document is emitted once for every number crossed within its own
step. Within a source documents stand in order of size, so what is taken
follows the target closely.

The running sums are built from counts: of each size within a source, of each
of ``SPLITS`` slices of a size, and the place within a slice. So no task holds
more than a slice, whatever share of the rows one source or one size has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
WEIGHTS = 3
SPLITS = 256
# Names that do not clash with columns of documents.
SIZE, SLICE, PLACE, COPIES, KEY = "__mix_size", "__mix_slice", "__mix_place", "__mix_copies", "__mix_key"
NAMED = "__mix_named"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows of source and size, one row for each source, null included.

    Sources by code point, null last, weigh 1 to ``WEIGHTS``, repeating, and
    share the total. No target is above ``MOST`` times its source's size: in
    order of that bound over weight, sources are filled up until the level that
    the rest would get by weight is below the next one's bound.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    weighed = by_source.withColumn("weight", (F.row_number().over(in_order) - 1) % WEIGHTS + 1)
    bound = MOST * F.col("source_size") / F.col("weight")
    filling = Window.orderBy("bound", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(MOST * F.col("source_size")).over(filling), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filling), F.lit(0))
    )
    levels = weighed.withColumn("bound", bound).withColumn("level", level)
    final = F.min(F.when(F.col("bound") >= F.col("level"), F.struct("bound", "level"))).over(every)["level"]
    target = F.least(MOST * F.col("source_size").cast("double"), F.col("weight") * F.coalesce(final, F.lit(0.0)))
    return levels.withColumn("target", target).select("source", "source_size", "target")


def _unit(value: Column) -> Column:
    """A number in [0, 1) from the digest of ``value``."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``docs`` with its size, source size and target, and how often the mix takes each row (``COPIES``).

    The new columns are ``SIZE``, ``source_size``, ``target`` and ``COPIES`` on
    top of those of ``docs``, of which ``doc_id``, ``text`` and ``source`` are
    read. The order within a size is that of a digest of the id and ``seed``, so
    reruns agree; repeated rows tie and are interchangeable, rows without an id
    come last. Null texts have size zero, null is a source of its own, and a mix
    of no words takes nothing.
    """
    # Never null, so that rows meet their counts under plain equality and the window keeps the join's partitions.
    named = F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("none"))
    name = F.concat(F.lit(f"{seed}:"), F.col(NAMED))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"))
    slice_ = F.coalesce(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % SPLITS, F.lit(SPLITS))
    clash = [c for c in docs.columns if c in ("source_size", "target")]
    sized = docs.drop(*clash).withColumns({SIZE: word_count(F.col("text")), SLICE: slice_, KEY: digest, NAMED: named})
    counts = sized.groupBy("source", SIZE, SLICE).agg(F.count(F.lit(1)).alias("n"))
    goal = targets(counts.select("source", (F.col(SIZE) * F.col("n")).alias("size")))
    by_size = counts.groupBy("source", SIZE).agg(F.sum("n").alias("of_size"))
    up_to = Window.partitionBy("source").orderBy(SIZE).rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.select("source", SIZE, F.coalesce(F.sum("of_size").over(up_to), F.lit(0)).alias("smaller"))
    within = Window.partitionBy("source", SIZE).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("source", SIZE, SLICE, F.coalesce(F.sum("n").over(within), F.lit(0)).alias("earlier"))
    before = (
        _same(counts, by_size, "source", SIZE)
        .join(goal.withColumnRenamed("source", "__goal"), F.expr("source <=> __goal"))
        .select(
            named.alias("__source"),
            F.col(SIZE).alias("__size"),
            F.col(SLICE).alias("__slice"),
            (F.col("earlier") + F.col("smaller")).alias("before"),
            "source_size",
            "target",
        )
    )
    place = Window.partitionBy(NAMED, SIZE, SLICE).orderBy(KEY, "doc_id")
    placed = sized.withColumn(PLACE, F.row_number().over(place))
    joined = placed.join(before, F.expr(f"{NAMED} = __source and {SIZE} = __size and {SLICE} = __slice"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    after = (F.col("before") + F.col(PLACE)) * rate + _unit(name)
    earlier = (F.col("before") + F.col(PLACE) - 1) * rate + _unit(name)
    copies = F.floor(after) - F.floor(earlier)
    return joined.withColumn(COPIES, copies.cast("int")).drop(
        "__source", "__size", "__slice", "before", PLACE, SLICE, KEY, NAMED
    )


def _same(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Join on equal keys, nulls equal; the keys come once."""
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in keys})
    where = " and ".join(f"{key} <=> __right_{key}" for key in keys)
    return left.join(renamed, F.expr(where)).drop(*(f"__right_{key}" for key in keys))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row; ``taken`` counts the words of all copies."""
    lean = docs.select("doc_id", "source", "text")
    return mixed(lean).select(
        "doc_id",
        F.col(SIZE).alias("size"),
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        (F.col(COPIES) * F.col(SIZE)).cast("long").alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in the mix, each as often as it is taken, with their own columns."""
    taken = mixed(docs).where(F.col(COPIES) > 0)
    return taken.withColumn(COPIES, F.explode(F.sequence(F.lit(1), F.col(COPIES)))).select(*docs.columns)


def mixing_sql() -> str:
    """The same report as DuckDB SQL."""
    return f"""
    WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
               md5('0:' || doc_id::VARCHAR) AS digest
        FROM documents
    ), by_source AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {WEIGHTS} + 1 AS weight
        FROM sized GROUP BY source
    ), bounds AS (SELECT *, {MOST} * source_size / weight AS bound FROM by_source
    ), levels AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum({MOST} * source_size) OVER filling, 0))
                  / (sum(weight) OVER () - coalesce(sum(weight) OVER filling, 0)) AS level
        FROM bounds
        WINDOW filling AS (ORDER BY bound, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), final AS (SELECT level FROM levels WHERE bound >= level ORDER BY bound, level LIMIT 1
    ), goals AS (
        SELECT source, source_size,
               least({MOST}::DOUBLE * source_size, weight * coalesce((SELECT level FROM final), 0.0)) AS target
        FROM levels
    ), ordered AS (
        SELECT s.*, source_size, target,
               CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
               row_number() OVER (
                   PARTITION BY s.source
                   ORDER BY size, coalesce(('0x' || substr(digest, 1, 8))::BIGINT % {SPLITS}, {SPLITS}), digest, doc_id
               ) AS place,
               ('0x' || substr(md5('0:' || coalesce('s:' || s.source, 'none')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
        FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
    )
    SELECT doc_id, size, source_size, target,
           (size * (floor(place * rate + shift) - floor((place - 1) * rate + shift)))::BIGINT AS taken
    FROM ordered
    """
