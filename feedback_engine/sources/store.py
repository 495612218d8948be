"""The five stored tables as parquet logs with one folder per batch.

A batch is written to its own folder, so ingesting never rewrites stored data,
a replayed batch replaces itself, and a lost executor only repeats its tasks.
Readers resolve the log to one row per key; ``compact`` writes the resolved
tables to a new root when the log has grown. From then on a reader only has to
resolve what came later, and merges that into the compacted rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedback_engine import schemas
from feedback_engine.operators.columns import align_schema
from feedback_engine.operators.dedup import first_per_key, latest_per_key
from feedback_engine.operators.upsert import insert_unseen, upsert

# Table -> schema, key, and whether a later batch overwrites an earlier row.
TABLES = {
    "users": (schemas.USERS, "user_id", False),
    "apps": (schemas.APPS, "app_id", True),
    "communities": (schemas.COMMUNITIES, "subreddit_id", False),
    "reviews": (schemas.REVIEWS, "review_key", True),
    "posts": (schemas.POSTS, "post_id", True),
}
# Folder levels: which feed wrote the batch, and its number within the feed.
FEED, BATCH = "feed", "batch_id"
# The feed that compaction writes; it holds one row per key.
BASE = "base"


def _within(up_to: Mapping[str, int]) -> Column:
    """Rows of the feeds named, up to the batch named with each."""
    return reduce(or_, [(F.col(FEED) == f) & (F.col(BATCH) <= n) for f, n in up_to.items()], F.lit(False))


class FeedbackStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def initialize(self) -> FeedbackStore:
        """Create missing tables; those that exist stay as they are."""
        for name, (schema, _, _) in TABLES.items():
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("ignore").parquet(self._folder(name, BASE, -1))
        return self

    def log(self, table: str) -> DataFrame:
        """All stored rows with their feed and batch.

        Columns that files of an older schema lack are filled with their
        defaults, which is all the migration an old store needs.
        """
        folders = [T.StructField(FEED, T.StringType()), T.StructField(BATCH, T.LongType())]
        logged = T.StructType([*TABLES[table][0].fields, *folders])
        stored = self.spark.read.schema(logged).parquet(f"{self.root}/{table}")
        return align_schema(stored, logged)

    def earlier(self, table: str, feed: str, batch_id: int) -> DataFrame:
        """The log as a batch finds it: without itself and what followed it.

        Unresolved, so a key may occur more than once. Folders that are left out
        are not read.
        """
        own = (F.col(FEED) == feed) & (F.col(BATCH) >= batch_id)
        return self.log(table).filter(~own)

    def read(self, table: str, up_to: Mapping[str, int] | None = None) -> DataFrame:
        """One row per key, optionally of each feed's batches up to one."""
        schema, key, overwrites = TABLES[table]
        log = self.log(table)
        recent = log.filter(F.col(FEED) != BASE)
        if up_to is not None:
            recent = recent.filter(_within(up_to))
        pick = latest_per_key if overwrites else first_per_key
        resolved = pick(recent, (key,), (BATCH, FEED)).select(*schema.fieldNames())
        base = log.filter(F.col(FEED) == BASE).select(*schema.fieldNames())
        return upsert(base, resolved, key) if overwrites else insert_unseen(base, resolved, [key])

    def write_batch(self, feed: str, batch_id: int, tables: dict[str, DataFrame]) -> None:
        """Write a batch's rows, unique on key; repeating it changes nothing."""
        if batch_id < 0:
            raise ValueError("batch_id must not be negative")
        for name, df in tables.items():
            aligned = align_schema(df, TABLES[name][0])
            aligned.write.mode("overwrite").parquet(self._folder(name, feed, batch_id))

    def compact(self, new_root: str, up_to: Mapping[str, int]) -> FeedbackStore:
        """Resolve each feed's batches up to the one named into the base of a new store.

        Later batches, and feeds that are not named, are carried over as they are.
        The new root must not exist: a base holds one row per key.
        """
        compacted = FeedbackStore(self.spark, new_root)
        if compacted.exists():
            raise ValueError(f"{new_root} exists")
        resolved = {name: self.read(name, up_to) for name in TABLES}
        compacted.write_batch(BASE, max(0, *up_to.values()) if up_to else 0, resolved)
        for name in TABLES:
            later = self.log(name).filter((F.col(FEED) != BASE) & ~_within(up_to))
            later.write.mode("append").partitionBy(FEED, BATCH).parquet(f"{compacted.root}/{name}")
        return compacted

    def exists(self) -> bool:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return folder.getFileSystem(conf).exists(folder)

    def _folder(self, table: str, feed: str, batch_id: int) -> str:
        return f"{self.root}/{table}/{FEED}={feed}/{BATCH}={batch_id}"
