"""Keyed inserts and updates as DataFrame operations.

Parquet tables know no ``MERGE``. An upsert is the stored rows whose key is not
in the batch (anti join) plus the batch's last row per key. The anti join sends
only the batch's keys across, and by broadcast where Spark finds them small, so
that a small batch does not shuffle a large store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_engine.functions import casts, keys
from feedback_engine.operators.columns import align_schema, backfill_quality, require_columns
from feedback_engine.operators.dedup import first_per_key, latest_per_key
from feedback_engine.operators.skew import salted_lookup
from feedback_engine.schemas import (
    COMMUNITIES,
    POST_PLATFORM,
    POSTS,
    REQUIRED_POST_COLUMNS,
    REVIEW_PLATFORM,
    REVIEWS,
    USERS,
)


# --- staging: cleaned batch -> rows of the stored tables ------------------------


def batch_review_key() -> Column:
    """The key of a cleaned review, from the columns of its batch."""
    return keys.review_key(
        F.col("app_id"),
        F.col("userName"),
        casts.timestamp_text(F.col("timestamp")),
        F.col("review_text"),
    )


def stage_reviews(batch: DataFrame) -> DataFrame:
    """Review rows ready to store, one per key (the last wins)."""
    keyed = backfill_quality(batch).select(
        "*",
        batch_review_key().alias("review_key"),
        # The id is a function of the name, so no look-up in Users is needed.
        keys.user_id(F.lit(REVIEW_PLATFORM), F.col("userName")).alias("user_id"),
        F.col("timestamp").alias("review_timestamp"),
        F.lit(REVIEW_PLATFORM).alias("source"),
    )
    return align_schema(latest_per_key(keyed, ("review_key",)), REVIEWS)


def stage_posts(batch: DataFrame) -> DataFrame:
    """Post rows ready to store, one per id (the last wins)."""
    author = F.nullif(F.col("author"), F.lit(casts.DELETED))
    staged = backfill_quality(require_columns(batch, REQUIRED_POST_COLUMNS)).select(
        "*",
        keys.user_id(F.lit(POST_PLATFORM), author).alias("user_id"),
        F.col("timestamp").alias("created_timestamp"),
        F.lit(POST_PLATFORM).alias("source"),
    )
    staged = staged.withColumn("subreddit_id", casts.strip_edges(F.col("subreddit_id")))
    return align_schema(latest_per_key(staged, ("post_id",)), POSTS)


def stage_apps(incoming: DataFrame) -> DataFrame:
    """The last name given for each app."""
    return latest_per_key(incoming, ("app_id",)).select(
        "app_id", "app_name", F.lit(REVIEW_PLATFORM).alias("platform")
    )


def stage_users(batch: DataFrame, name: str, platform: str) -> DataFrame:
    """Distinct users of a batch; deleted accounts are no users."""
    return (
        batch.select(F.col(name).alias("username"))
        .filter((F.col("username") != casts.DELETED) if platform == POST_PLATFORM else F.lit(True))
        .filter(F.col("username").isNotNull())
        .distinct()
        .select(
            keys.user_id(F.lit(platform), F.col("username")).alias("user_id"),
            "username",
            F.lit(platform).alias("platform"),
        )
    )


def stage_communities(batch: DataFrame) -> DataFrame:
    """Communities of a batch with the order they first appeared in.

    Aggregated per pair before anything is shuffled whole, so a community with
    a third of all posts costs one row per task.
    """
    return (
        batch.groupBy(
            casts.strip_edges(F.col("subreddit_id")).alias("subreddit_id"),
            F.lower("subreddit_name").alias("name"),
        )
        .agg(F.min("arrival_seq").alias("arrival_seq"))
        .filter(F.col("subreddit_id") != "")
    )


# --- merging into stored tables --------------------------------------------------


def known_keys(stored: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Those keys of a batch that are stored, each once.

    The stored table may be a log with repeated keys and far larger than the
    batch: it is only filtered by the batch's keys, which needs no shuffle of it
    where Spark finds the batch small enough to broadcast.
    """
    return stored.select(*key).join(batch.select(*key), key, "left_semi").distinct()


def unseen(stored: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Rows of a batch whose key is not stored."""
    return batch.join(known_keys(stored, batch, key), key, "left_anti").select(*batch.columns)


def insert_unseen(stored: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Stored rows, plus the batch's rows under new keys."""
    return stored.unionByName(unseen(stored, batch, key).select(*stored.columns))


def upsert(existing: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Stored rows not in the batch, plus the batch; ``staged`` is unique on key.

    The batch is read twice: hand in one that is written already, not one that
    would have to be cleaned again.
    """
    untouched = existing.join(staged.select(key), key, "left_anti").select(*existing.columns)
    return untouched.unionByName(staged.select(*existing.columns))


def upsert_apps(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert apps, or overwrite name and platform."""
    return upsert(existing, stage_apps(incoming), "app_id")


def new_users(existing: DataFrame, staged: DataFrame) -> DataFrame:
    """Users of the batch that are not stored yet."""
    return align_schema(unseen(existing, staged, ["username", "platform"]), USERS)


def new_communities(existing: DataFrame, staged: DataFrame) -> DataFrame:
    """Communities whose id and name are both unknown; the first claim wins."""
    new_id = unseen(existing, staged, ["subreddit_id"])
    by_id = first_per_key(
        unseen(existing, new_id, ["name"]), ("subreddit_id",), ("arrival_seq", "name")
    )
    by_name = first_per_key(by_id, ("name",), ("arrival_seq", "subreddit_id"))
    return align_schema(by_name, COMMUNITIES)


def insert_users(existing: DataFrame, staged: DataFrame) -> DataFrame:
    return existing.unionByName(new_users(existing, staged))


def insert_communities(existing: DataFrame, staged: DataFrame) -> DataFrame:
    return existing.unionByName(new_communities(existing, staged))


def lookup_user_id(facts: DataFrame, users: DataFrame, **skew) -> DataFrame:
    """Ids by (username, platform) for stores whose ids are not derived from names.

    Deleted accounts have a null name and keep a null id. One placeholder name
    can own a large part of the rows, hence the salted join.
    """
    return salted_lookup(facts, users, ("username", "platform"), "arrival_seq", **skew)


def affected_rows(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows that came in, how many keys were new, and the rest: updates.

    ``existing`` may hold a key more than once, as a log does.
    """
    per_key = incoming.groupBy(key).agg(F.count("*").alias("rows"))
    known = known_keys(existing, per_key, [key]).withColumn("known", F.lit(1))
    return (
        per_key.join(known, key, "left")
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("affected"),
            F.count_if(F.col("known").isNull()).alias("inserted"),
        )
        .select("affected", "inserted", (F.col("affected") - F.col("inserted")).alias("updated"))
    )
