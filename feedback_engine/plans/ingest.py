"""Write a cleaned batch to the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.operators import upsert
from feedback_engine.operators.integrity import check_communities
from feedback_engine.operators.report import observe_stage
from feedback_engine.schemas import POST_PLATFORM, REVIEW_PLATFORM
from feedback_engine.session import new_workspace
from feedback_engine.sources.store import FeedbackStore

REVIEW_FEED, POST_FEED = "reviews", "posts"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Three tables are derived from a cleaned batch; without this each would
    clean the texts again.
    """
    path = new_workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_observed(df: DataFrame, label: str, stage: str) -> tuple[DataFrame, DataFrame]:
    """As ``materialize``; the batch's numbers, one row, are counted by the tasks that write it."""
    observed, totals = observe_stage(df, stage)
    written = materialize(observed, label)
    row = {"stage": stage, **totals.get}
    schema = "stage string, n_rows long, low_signal_rows long, avg_quality double"
    return written, df.sparkSession.createDataFrame([row], schema)


def store_reviews(
    store: FeedbackStore, batch_id: int, reviews: DataFrame, apps: DataFrame
) -> DataFrame:
    """Upsert apps, users and reviews of one batch; returns the affected counts.

    ``apps`` holds app_id, app_name and arrival_seq for the apps of the batch; those
    of which no review survived are not stored.
    """
    batch = materialize(reviews, "reviews")
    apps = apps.join(batch.select("app_id"), "app_id", "left_semi")
    keyed = batch.select(upsert.batch_review_key().alias("review_key"))
    stored = store.earlier("reviews", REVIEW_FEED, batch_id)
    counts = upsert.affected_rows(stored, keyed, "review_key")
    store.write_batch(REVIEW_FEED, batch_id, {
        "apps": upsert.stage_apps(apps),
        "users": upsert.new_users(
            store.earlier("users", REVIEW_FEED, batch_id),
            upsert.stage_users(batch, "userName", REVIEW_PLATFORM),
        ),
        "reviews": upsert.stage_reviews(batch),
    })
    return counts


def split_communities(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posts of communities that have exactly one id, and the others for quarantine."""
    refused = check_communities(posts).filter("is_valid = 0").select(F.col("name").alias("_name"))
    name = F.lower("subreddit_name").eqNullSafe(F.col("_name"))
    return posts.join(refused, name, "left_anti"), posts.join(refused, name, "left_semi")


def store_posts(store: FeedbackStore, batch_id: int, posts: DataFrame) -> DataFrame:
    """Upsert communities, users and posts of one batch; returns the affected counts.

    Posts of a community that has several ids, or a blank one, are not stored;
    ``split_communities`` tells which they are.
    """
    batch = materialize(split_communities(materialize(posts, "landed_posts"))[0], "posts")
    stored = store.earlier("posts", POST_FEED, batch_id)
    counts = upsert.affected_rows(stored, batch.select("post_id"), "post_id")
    store.write_batch(POST_FEED, batch_id, {
        "communities": upsert.new_communities(
            store.earlier("communities", POST_FEED, batch_id), upsert.stage_communities(batch)
        ),
        "users": upsert.new_users(
            store.earlier("users", POST_FEED, batch_id),
            upsert.stage_users(batch, "author", POST_PLATFORM),
        ),
        "posts": upsert.stage_posts(batch),
    })
    return counts
