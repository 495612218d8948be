"""Send each recognised input to the pipeline that serves it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.functions.dispatch import APP, COMMUNITY, POST, classify_source
from feedback_engine.operators.dedup import latest_per_key
from feedback_engine.plans.ingest import store_posts, store_reviews
from feedback_engine.plans.posts import chosen_posts, post_pipeline
from feedback_engine.plans.reviews import Language, review_pipeline
from feedback_engine.session import new_workspace
from feedback_engine.sources.store import FeedbackStore


def classify_inputs(inputs: DataFrame, text: str) -> DataFrame:
    """Inputs with the source kind and value they stand for."""
    return inputs.withColumn("_source", classify_source(F.col(text))).select(
        *inputs.columns, "_source.kind", "_source.value"
    )


def route_by_source(classified: DataFrame) -> dict[str, DataFrame]:
    """One DataFrame per kind; what no form fits goes nowhere."""
    return {kind: classified.filter(F.col("kind") == kind) for kind in (APP, POST, COMMUNITY)}


def written_by_kind(classified: DataFrame) -> DataFrame:
    """Each different (kind, value) once, written in one pass with a folder for each kind.

    Filtered by kind, the result reads that folder alone.
    """
    spark = classified.sparkSession
    wanted = classified.filter("kind IS NOT NULL AND value IS NOT NULL").select("kind", "value").distinct()
    path = new_workspace(spark, "requests")
    wanted.write.partitionBy("kind").parquet(path)
    return spark.read.schema("value string, kind string").parquet(path)


def requested_reviews(requests: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed reviews of the apps asked for."""
    apps = route_by_source(requests)[APP].select(F.col("value").alias("app_id"))
    return landed.join(apps, "app_id", "left_semi")


def requested_by_id(requests: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed posts asked for by id, in either case."""
    ids = route_by_source(requests)[POST].select(F.col("value").alias("_id"))
    return landed.join(ids, F.lower(landed["id"]) == ids["_id"], "left_semi")


def requested_by_community(requests: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed posts of the communities asked for, in either case."""
    names = route_by_source(requests)[COMMUNITY].select(F.col("value").alias("_name"))
    return landed.join(names, F.lower(landed["subreddit.display_name"]) == names["_name"], "left_semi")


def ingest_requested(
    store: FeedbackStore,
    batch_id: int,
    classified: DataFrame,
    landed_reviews: DataFrame,
    landed_posts: DataFrame,
    apps: Callable[[DataFrame], DataFrame],
    language: Language = None,
    **options,
) -> DataFrame:
    """Run the pipeline of every kind that is asked for, into the store, as one batch of each feed.

    ``classified`` has kind and value, as ``classify_inputs`` gives them;
    ``apps`` derives app rows from landed reviews. A post that is asked for by
    its id is stored even where it repeats another of its community. Returns
    the affected counts with the name of their ``feed``.
    """
    requests = written_by_kind(classified)
    reviews = requested_reviews(requests, landed_reviews)
    posts = post_pipeline(requested_by_community(requests, landed_posts), language, **options).unionByName(
        chosen_posts(requested_by_id(requests, landed_posts), language, **options)
    )
    counts = {
        "reviews": store_reviews(store, batch_id, review_pipeline(reviews, language, **options), apps(reviews)),
        "posts": store_posts(store, batch_id, latest_per_key(posts, ("post_id",))),
    }
    named = [df.withColumn("feed", F.lit(feed)) for feed, df in counts.items()]
    return named[0].unionByName(named[1])
