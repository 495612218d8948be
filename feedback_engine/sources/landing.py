"""Landed raw records -> DataFrames with one row per review or post."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedback_engine.functions import casts
from feedback_engine.operators.columns import missing_columns
from feedback_engine.schemas import RAW_POST, RAW_REVIEW, REQUIRED_REVIEW_COLUMNS

CORRUPT = "_corrupt_record"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share rows out by key where a source has fewer partitions than there are cores.

    Cleaning costs far more than a shuffle of the raw rows, so a file that cannot
    be split (a single row group, gzip) must not end up in one task. A source
    with enough partitions is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


class Landed(NamedTuple):
    """What was landed: usable records, and lines that are none, with the reason."""

    records: DataFrame
    quarantined: DataFrame


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> Landed:
    """Landed files with a declared schema: parquet, ORC, or JSON lines.

    Only lines can be broken; the other formats have nothing in quarantine.
    """
    if fmt == "json":
        return split_corrupt(parse_json_lines(spark.read.text(path), schema))
    nothing = spark.createDataFrame([], f"{CORRUPT} string, reason string")
    return Landed(spark.read.schema(schema).format(fmt).load(path), nothing)


def parse_json_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """One record per line of ``value``; a line that is no record is kept in a column of its own.

    That is a line that is blank, that does not parse, or that holds none of the
    declared fields.
    """
    parsed = F.from_json(
        "value",
        T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    records = lines.select("value", parsed.alias("record"))
    fields = [F.col(f"record.{name}") for name in schema.fieldNames()]
    empty = reduce(and_, [field.isNull() for field in fields])
    kept = F.when(empty, F.col("value")).otherwise(F.col(f"record.{CORRUPT}"))
    return records.select(*fields, kept.alias(CORRUPT))


def split_corrupt(parsed: DataFrame) -> Landed:
    """Usable records, and the other lines for quarantine: ``blank`` or ``broken``."""
    broken = F.col(CORRUPT).isNotNull()
    reason = F.when(F.col(CORRUPT).rlike(r"\S"), "broken").otherwise("blank").alias("reason")
    return Landed(parsed.filter(~broken).drop(CORRUPT), parsed.filter(broken).select(CORRUPT, reason))


def scan_reviews(landed: DataFrame, on_missing: str = "raise") -> DataFrame:
    """Landed reviews under the engine's names.

    A batch without an expected column raises, or with ``on_missing='empty'``
    counts as a batch without rows.
    """
    missing = missing_columns(landed, REQUIRED_REVIEW_COLUMNS)
    if missing and on_missing == "raise":
        raise ValueError(f"landed reviews lack columns: {missing}")
    if missing:
        landed = landed.sparkSession.createDataFrame([], RAW_REVIEW)
    return landed.withColumnsRenamed({"date": "timestamp", "review": "review_text"})


def typed_reviews(reviews: DataFrame, dates: Sequence[str] | str = casts.MONTH_FIRST) -> DataFrame:
    """Names, ratings and times cast; nothing dropped yet.

    ``dates`` are the forms of dates beside ISO, or ``VOTE``: then each app's
    dates tell whether 01/05/2024 starts with the day or the month.
    """
    day_first = None
    if dates == VOTE:
        kept, dates = reviews.columns, casts.MONTH_FIRST
        reviews, day_first = _with_vote(reviews, "app_id", "timestamp")
    else:
        kept = reviews.columns
    return reviews.withColumns({
        "userName": casts.review_author(F.col("userName")),
        "rating": casts.cast_rating(F.col("rating")),
        "title": casts.empty_if_null(F.col("title")),
        "timestamp": casts.parse_timestamp_utc(F.col("timestamp"), dates, day_first),
    }).select(*kept)


# Take the order of day and month from the batch itself.
VOTE = "vote"
# Sources with the day first that are named in the plan; more are joined.
NAMED_SOURCES = 1000


def day_first_sources(df: DataFrame, source: str, date: str) -> DataFrame:
    """Sources of a batch in which more dates can only have the day first than only the month.

    One aggregate over the two columns. A source whose dates fit both ways, or
    that is evenly split, is not among them.
    """
    votes = df.groupBy(source).agg(F.sum(casts.day_first_evidence(F.col(date))).alias("votes"))
    return votes.filter("votes > 0").select(source)


def _with_vote(df: DataFrame, source: str, date: str) -> tuple[DataFrame, Column]:
    """``df`` and a column that says whether its row's source has the day first."""
    found = day_first_sources(df, source, date)
    some = [row[0] for row in found.limit(NAMED_SOURCES + 1).collect()]
    if len(some) <= NAMED_SOURCES:
        named = [s for s in some if s is not None]
        known = F.coalesce(F.col(source).isin(named), F.lit(False)) if named else F.lit(False)
        return df, known | F.col(source).isNull() if None in some else known
    marked = found.select(F.col(source).alias("_source"), F.lit(True).alias("_day_first"))
    joined = df.join(marked, F.col(source).eqNullSafe(F.col("_source")), "left")
    return joined, F.coalesce(F.col("_day_first"), F.lit(False))


def scan_posts(landed: DataFrame) -> DataFrame:
    """Nested submissions flattened, with defaults for what is absent."""
    own = [f for f in landed.columns if f not in RAW_POST.fieldNames()]
    return landed.select(
        "arrival_seq",
        F.col("id").alias("post_id"),
        F.lower("subreddit.display_name").alias("subreddit_name"),
        casts.community_id(
            F.col("subreddit_id"), F.col("subreddit.fullname"), F.col("subreddit.id")
        ).alias("subreddit_id"),
        casts.post_author(F.col("author")).alias("author"),
        casts.empty_if_null(F.col("title")).alias("title"),
        casts.empty_if_null(F.col("selftext")).alias("post_text"),
        F.col("score").cast("int").alias("score"),
        F.col("num_comments").cast("int").alias("num_comments"),
        casts.epoch_to_timestamp(F.col("created_utc")).alias("timestamp"),
        casts.empty_if_null(F.col("link_flair_text")).alias("flair"),
        F.col("url").alias("post_url"),
        *own,
    )


def scan_post_by_id(landed: DataFrame, post_id: str) -> DataFrame:
    """One post; the id reaches the file scan as a pushed filter."""
    return scan_posts(landed.filter(F.col("id") == post_id))
