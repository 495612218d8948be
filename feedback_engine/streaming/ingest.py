"""Ingest newly landed files with Structured Streaming.

Each trigger takes the files that arrived since the last one, up to a limit,
cleans and de-duplicates them as one batch, and upserts them under the
micro-batch id. Of JSON lines, those that are no record go to a quarantine
folder under the same id. A replayed micro-batch overwrites its own folders, in
the store and in quarantine, with the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedback_engine.plans.ingest import store_posts, store_reviews
from feedback_engine.plans.posts import post_pipeline
from feedback_engine.plans.reviews import Language, review_pipeline
from feedback_engine.schemas import RAW_POST, RAW_REVIEW
from feedback_engine.sources.landing import parse_json_lines, split_corrupt
from feedback_engine.sources.store import BATCH, FeedbackStore


@dataclass(frozen=True)
class Arrivals:
    """Where and how files land.

    ``fmt`` is parquet, orc or json (lines, which need a ``quarantine`` folder).
    At most ``max_files`` or ``max_bytes`` make one micro-batch; Spark takes one
    of the two. ``checkpoint`` belongs to one store for good: in a new one batch
    ids would start over.
    """

    landing: str
    checkpoint: str
    fmt: str = "parquet"
    quarantine: str | None = None
    max_files: int | None = None
    max_bytes: int | None = None

    def __post_init__(self) -> None:
        if self.fmt == "json" and not self.quarantine:
            raise ValueError("JSON lines need a quarantine folder")
        if self.max_files is not None and self.max_bytes is not None:
            raise ValueError("give max_files or max_bytes, not both")

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        reader = spark.readStream
        for option, value in (("maxFilesPerTrigger", self.max_files), ("maxBytesPerTrigger", self.max_bytes)):
            if value is not None:
                reader = reader.option(option, value)
        return reader.text(self.landing) if self.fmt == "json" else reader.schema(schema).format(self.fmt).load(self.landing)

    def records(self, landed: DataFrame, batch_id: int, schema: T.StructType) -> DataFrame:
        """The usable records of a micro-batch; the other lines are written to quarantine."""
        if self.fmt != "json":
            return landed
        records, broken = split_corrupt(parse_json_lines(landed, schema))
        broken.write.mode("overwrite").parquet(f"{self.quarantine.rstrip('/')}/{BATCH}={batch_id}")
        return records


def _ingest(
    spark: SparkSession,
    arrivals: Arrivals,
    schema: T.StructType,
    store_batch: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    """Process everything landed so far, then stop."""

    def both(landed: DataFrame, batch_id: int) -> None:
        store_batch(arrivals.records(landed, batch_id, schema), batch_id)

    return (
        arrivals.read(spark, schema)
        .writeStream.foreachBatch(both)
        .option("checkpointLocation", arrivals.checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_reviews(
    spark: SparkSession,
    arrivals: Arrivals,
    store: FeedbackStore,
    apps: Callable[[DataFrame], DataFrame],
    language: Language = None,
    **options,
) -> StreamingQuery:
    """Landed reviews into apps, users and reviews.

    ``apps`` derives the batch's app rows (app_id, app_name, arrival_seq) from
    its landed reviews.
    """

    def store_batch(landed: DataFrame, batch_id: int) -> None:
        reviews = review_pipeline(landed, language, **options)
        store_reviews(store, batch_id, reviews, apps(landed))

    return _ingest(spark, arrivals, RAW_REVIEW, store_batch)


def ingest_posts(
    spark: SparkSession, arrivals: Arrivals, store: FeedbackStore, language: Language = None, **options
) -> StreamingQuery:
    """Landed posts into communities, users and posts."""

    def store_batch(landed: DataFrame, batch_id: int) -> None:
        store_posts(store, batch_id, post_pipeline(landed, language, **options))

    return _ingest(spark, arrivals, RAW_POST, store_batch)
