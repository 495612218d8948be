"""Checks a database would enforce, as queries that list what breaks them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.functions.casts import strip_edges
from feedback_engine.operators.filters import RATING_RANGE

# Columns that may not be null, unique keys, references.
NOT_NULL = {
    "users": ("username", "platform"),
    "apps": ("app_id", "app_name", "platform"),
    "reviews": ("review_key", "app_id", "review_text", "source"),
    "communities": ("subreddit_id", "name"),
    "posts": ("post_id", "subreddit_id", "source"),
}
UNIQUE = {
    "users": (("username", "platform"),),
    "apps": (("app_id",),),
    "reviews": (("review_key",),),
    "communities": (("subreddit_id",), ("name",)),
    "posts": (("post_id",),),
}
REFERENCES = (
    ("reviews", "app_id", "apps", "app_id"),
    ("reviews", "user_id", "users", "user_id"),
    ("posts", "subreddit_id", "communities", "subreddit_id"),
    ("posts", "user_id", "users", "user_id"),
)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_domain(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of NOT NULL and of the rating range, counted per rule.

    One scan per table: all its rules are counted together.
    """
    results = []
    for name, df in tables.items():
        rules = {f"{c} is null": F.col(c).isNull() for c in NOT_NULL[name]}
        if name == "reviews":
            rules["rating out of range"] = ~F.col("rating").between(*RATING_RANGE)
        counts = df.agg(*[F.count_if(rule).alias(label) for label, rule in rules.items()])
        results.append(
            counts.unpivot([], list(rules), "rule", "violations").select(
                F.lit(name).alias("table_name"), "rule", "violations"
            )
        )
    return _union(results)


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys that occur more than once, with how often.

    Each table is read once: its keys become rows of their own, which are counted
    together. The parts of a key stay apart, so no two keys look alike.
    """
    claims = []
    for name, df in tables.items():
        keys = [
            F.struct(F.lit(",".join(key)).alias("key_name"), F.array(*[F.col(c).cast("string") for c in key]).alias("parts"))
            for key in UNIQUE[name]
        ]
        claims.append(df.select(F.lit(name).alias("table_name"), F.inline(F.array(*keys))))
    repeated = _union(claims).groupBy("table_name", "key_name", "parts").agg(F.count("*").alias("n"))
    return repeated.filter("n > 1").select("table_name", "key_name", F.concat_ws("|", "parts").alias("key_value"), "n")


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """References to missing rows, with how many rows hold each; null refers to none.

    Each table is read once for the references it holds and once for the keys
    that others refer to. References are counted per value first, so popular
    values join as one row; one join finds those of no parent.
    """
    known = [r for r in REFERENCES if r[0] in tables and r[2] in tables]
    referred = []
    for name in dict.fromkeys(r[0] for r in known):
        held = [
            F.struct(F.lit(column).alias("column_name"), F.lit(parent).alias("parent"), F.col(column).cast("string").alias("value"))
            for child, column, parent, _ in known
            if child == name
        ]
        referred.append(tables[name].select(F.lit(name).alias("table_name"), F.inline(F.array(*held))))
    counts = (
        _union(referred).filter(F.col("value").isNotNull())
        .groupBy("table_name", "column_name", "parent", "value").agg(F.count("*").alias("n"))
    )
    keys = _union([
        tables[parent].select(F.lit(parent).alias("parent"), F.col(key).cast("string").alias("value"))
        for parent, key in dict.fromkeys(r[2:] for r in known)
    ])
    return counts.join(keys, ["parent", "value"], "left_anti").select("table_name", "column_name", "value", "n")


def check_communities(batch: DataFrame) -> DataFrame:
    """Per community name: its ids, and whether the batch may be stored.

    A name needs exactly one id as it came (null counts as a value, and so does
    white space around it) and that id not blank; an id must not be claimed by
    two names.
    """
    pairs = batch.groupBy(
        F.lower("subreddit_name").alias("name"), F.col("subreddit_id").alias("id")
    ).agg(F.count("*").alias("rows"))
    names_per_id = pairs.groupBy("id").agg(F.count("*").alias("names"))
    return (
        pairs.join(names_per_id, pairs["id"].eqNullSafe(names_per_id["id"]), "left")
        .drop(names_per_id["id"])
        .groupBy("name")
        .agg(
            F.count("*").alias("n_ids"),
            F.max("names").alias("max_names_per_id"),
            F.count_if(strip_edges(F.coalesce(F.col("id"), F.lit(""))) == "").alias("blank_ids"),
            F.sum("rows").alias("n_rows"),
        )
        .withColumn(
            "is_valid",
            (
                (F.col("n_ids") == 1)
                & (F.col("max_names_per_id") == 1)
                & (F.col("blank_ids") == 0)
            ).cast("int"),
        )
    )
