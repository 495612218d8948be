"""Schemas of landed records and of the five stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(spec: str) -> list[T.StructField]:
    names = {
        "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
        "double": T.DoubleType(), "timestamp": T.TimestampType(),
    }
    pairs = (item.split() for item in spec.split(","))
    return [T.StructField(name, names[kind]) for name, kind in pairs]


# The six quality columns both fact tables carry.
QUALITY = T.StructType(_fields(
    "cleaned_length int, word_count int, language string, quality_score double, "
    "is_low_signal int, low_signal_reasons string"
))

# What a column holds when a writer did not supply it (else null).
DEFAULTS = {"is_low_signal": 0}

RAW_REVIEW = T.StructType(_fields(
    "arrival_seq bigint, app_id string, userName string, rating string, title string, "
    "date string, review string"
))

RAW_POST = T.StructType(
    _fields("arrival_seq bigint, id string, title string, selftext string, url string")
    + [T.StructField(
        "subreddit", T.StructType(_fields("display_name string, fullname string, id string"))
    )]
    + _fields(
        "subreddit_id string, author string, score int, num_comments int, created_utc double, "
        "link_flair_text string"
    )
)

USERS = T.StructType(_fields("user_id string, username string, platform string"))
APPS = T.StructType(_fields("app_id string, app_name string, platform string"))
COMMUNITIES = T.StructType(_fields("subreddit_id string, name string"))
REVIEWS = T.StructType(
    _fields(
        "review_key string, app_id string, user_id string, rating int, title string, "
        "review_text string, review_timestamp timestamp, source string"
    )
    + QUALITY.fields
)
POSTS = T.StructType(
    _fields(
        "post_id string, subreddit_id string, user_id string, title string, post_text string, "
        "score int, num_comments int, created_timestamp timestamp, flair string, post_url string, "
        "source string"
    )
    + QUALITY.fields
)

# Columns a batch of posts must bring to be stored.
REQUIRED_POST_COLUMNS = (
    "post_id", "subreddit_id", "subreddit_name", "author", "title", "post_text",
    "score", "num_comments", "timestamp", "flair", "post_url",
)
# Columns a landed batch of reviews must bring.
REQUIRED_REVIEW_COLUMNS = ("date", "review", "userName", "rating", "title")

REVIEW_PLATFORM = "apple"
POST_PLATFORM = "reddit"
