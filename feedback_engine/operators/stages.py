"""How many rows each stage of a batch keeps and drops, per source.

One aggregation per de-duplication key (a digest stands in for the texts) tells
the whole story: its groups are the rows left after de-duplication, their sizes
the rows before, and what the filters say of a group is what they say of its
first copy, as that is the one that stays. Hot keys shrink to one row per task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_engine.functions.keys import text_digest


def stage_counts(
    cleaned: DataFrame,
    source: str,
    owner: str,
    texts: tuple[str, ...],
    filters: dict[str, Column],
    seq: str = "arrival_seq",
) -> DataFrame:
    """Per source: rows, copies removed, rows each filter drops in turn, rows left."""
    flags = [F.coalesce(ok, F.lit(False)).alias(name) for name, ok in filters.items()]
    groups = (
        cleaned.select(
            source, owner, seq, text_digest(*map(F.col, texts)).alias("_digest"), F.struct(*flags).alias("_ok")
        )
        .groupBy(source, owner, "_digest")
        .agg(F.count("*").alias("_copies"), F.min_by("_ok", seq).alias("_ok"))
    )
    passed = F.lit(True)
    dropped = []
    for name in filters:
        ok = F.col(f"_ok.{name}")
        dropped.append(F.count_if(passed & ~ok).alias(f"dropped_{name}"))
        passed = passed & ok
    return groups.groupBy(source).agg(
        F.sum("_copies").alias("rows_after_clean"),
        (F.sum("_copies") - F.count("*")).alias("duplicates_removed"),
        *dropped,
        F.count_if(passed).alias("rows_final"),
    )


def stage_comparison(raw: DataFrame, counts: DataFrame, source: str) -> DataFrame:
    """Raw, cleaned and final row counts side by side; both inputs are per source."""
    arrived = raw.groupBy(source).agg(F.count("*").alias("rows_raw"))

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return arrived.join(counts, source, "full").select(
        source, or_zero("rows_raw"), or_zero("rows_after_clean"), or_zero("rows_final")
    )
