"""A look-up join that survives keys holding a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001
SALTS = 256


def hot_keys(df: DataFrame, keys: tuple[str, ...], share: float) -> DataFrame:
    """Keys that hold at least this share of all rows: never more than 1 / share of them."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_total"))  # one row
    return (
        counts.join(total, F.col("_rows") >= F.col("_total") * share)
        .select(*keys, F.lit(True).alias("_hot"))
    )


def salted_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    keys: tuple[str, ...],
    spread: str,
    share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Left join of facts to a look-up table that is unique on ``keys``.

    Rows of hot keys are spread over ``salts`` partitions by a hash of the
    ``spread`` column, and only those keys are repeated on the look-up side.
    Rows with a null key match nothing and are spread as well. Hot keys are at
    most 1 / share; whether they are broadcast is left to Spark's size check.
    """
    hot = hot_keys(facts, keys, share)
    spread_out = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()

    salted_facts = facts.join(hot, list(keys), "left").withColumn(
        "_salt", F.when(F.col("_hot") | no_key, spread_out).otherwise(F.lit(0))
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_lookup_side = (
        lookup.join(hot, list(keys), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    return salted_facts.join(salted_lookup_side, [*keys, "_salt"], "left").drop("_salt", "_hot")
