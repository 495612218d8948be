"""Raw feedback batches derived from the shared test tables.

The expressions are plain SQL that Spark and DuckDB read alike, so the engine
and its reference queries start from the same rows. Every document gives one
long review, with its whole text, and one short canned review; every
conversation turn gives one post and one repost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_engine.sources.landing import spread

KEYS = {"documents": ("doc_id",), "conversations": ("conv_id", "turn"), "pages": ("page_id",)}

SECOND_BATCH = 1_000_000_000_000

LONG_REVIEW = """CASE n_chars % 4
  WHEN 0 THEN 'Visit https://shop.example.com/a?b=1 now ' || text || ' www.x.example'
  WHEN 1 THEN 'I don''t think it''s gooood, we’re soooo “tired”!!!! ' || text
  WHEN 2 THEN text || ' 😀👍🏽 1️⃣ ™'
  ELSE text END"""

SHORT_REVIEW = """CASE doc_id % 6
  WHEN 0 THEN '' WHEN 1 THEN lang || '!' WHEN 2 THEN 'good!!!' WHEN 3 THEN '12345 67890 ??? 4.'
  WHEN 4 THEN '哈哈哈这个应用真的很好用 推荐大家下载' ELSE NULL END"""

LONG_USER = """CASE WHEN n_chars % 17 = 0 THEN NULL
  WHEN n_chars % 13 = 0 THEN '  u' || cast(n_chars % 40 AS string) || ' '
  ELSE 'u' || cast(n_chars % 40 AS string) END"""

SHORT_USER = "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'c' || cast(doc_id % 3 AS string) END"

RATING = """CASE WHEN doc_id % 19 = 0 THEN 'n/a' WHEN doc_id % 23 = 0 THEN '0'
  WHEN doc_id % 29 = 0 THEN '4.7' WHEN doc_id % 31 = 0 THEN '6'
  ELSE cast(1 + doc_id % 5 AS string) END"""

TITLE = """CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 'It’s “' || lang || '” & review #' ||
  cast(doc_id AS string) || CASE WHEN doc_id % 3 = 0 THEN ' 👍🏽 1️⃣ ™' ELSE '' END ||
  ' www.x.example/' || source END"""

_DAY_NUMBER = "lpad(cast(1 + doc_id % 28 AS string), 2, '0')"
_DAY = f"'{{year}}-{{month}}-' || {_DAY_NUMBER}"
_HOUR = "lpad(cast(doc_id % 24 AS string), 2, '0') || ':' || lpad(cast(doc_id % 60 AS string), 2, '0')"
# ISO with and without an offset and a fraction, and five other forms. Of the dates in numbers, English apps write the
# month first, the others the day.
DATE = f"""CASE WHEN doc_id % 37 = 0 THEN 'not a date'
  WHEN doc_id % 10 = 3 THEN {_DAY} || 'T' || {_HOUR} || ':00+02:00'
  WHEN doc_id % 10 = 5 THEN {_DAY} || ' ' || {_HOUR} || ':30.75'
  WHEN doc_id % 10 = 1 THEN {_DAY_NUMBER} || ' {{name}} {{year}} ' || {_HOUR} || ':09 GMT'
  WHEN doc_id % 10 = 2 THEN '{{year}}/{{month}}/' || {_DAY_NUMBER} || ' ' || {_HOUR}
  WHEN doc_id % 10 = 4 THEN '{{year}}{{month}}' || {_DAY_NUMBER}
  WHEN doc_id % 10 = 7 AND lang = 'en' THEN '{{month}}/' || {_DAY_NUMBER} || '/{{year}} ' || {_HOUR}
  WHEN doc_id % 10 = 7 THEN {_DAY_NUMBER} || '/{{month}}/{{year}} ' || {_HOUR}
  WHEN doc_id % 10 = 9 THEN '{{name}} ' || {_DAY_NUMBER} || ', {{year}}'
  ELSE {_DAY} || ' ' || {_HOUR} || ':00' END"""


def _reviews(shift: int, body: str, user: str, rating: str, date: str) -> str:
    return f"""SELECT doc_id * 2 + {shift} AS arrival_seq,
  lang || '-' || cast(n_chars % 10 AS string) AS app_id,
  {user} AS userName, {rating} AS rating, {TITLE} AS title, {date} AS date, {body} AS review,
  lang AS lang_hint FROM documents"""


FIRST_DATE = DATE.format(year="2024", month="01", name="Jan")
RAW_REVIEWS = (
    _reviews(0, LONG_REVIEW, LONG_USER, RATING, FIRST_DATE)
    + " UNION ALL "
    + _reviews(1, SHORT_REVIEW, SHORT_USER, RATING, FIRST_DATE)
)

# The same reviews seen again: new ratings, for odd documents at a later date
# (so new keys), and some users under new names.
LATER_DATE = f"CASE WHEN doc_id % 2 = 1 THEN {DATE.format(year='2025', month='02', name='Feb')} ELSE {FIRST_DATE} END"
LATER_USER = (
    "CASE WHEN doc_id % 5 = 0 THEN 'n' || cast(n_chars % 7 AS string) ELSE {user} END"
)
RAW_REVIEWS_LATER = (
    _reviews(SECOND_BATCH, LONG_REVIEW, LATER_USER.format(user=LONG_USER), "'1'", LATER_DATE)
    + " UNION ALL "
    + _reviews(
        SECOND_BATCH + 1, SHORT_REVIEW, LATER_USER.format(user=SHORT_USER), "'1'", LATER_DATE
    )
)

REVIEW_LANGUAGE = "CASE WHEN length({text}) < 20 THEN NULL ELSE lang_hint END"

_K = "cast(conv_id % 5 AS string)"


def _posts(shift: int, prefix: str, body: str) -> str:
    return f"""SELECT (conv_id * 1000 + turn) * 2 + {shift} AS arrival_seq,
  '{prefix}' || cast(conv_id AS string) || '_' || cast(turn AS string) AS id,
  CASE WHEN turn % 5 = 4 THEN '' WHEN turn % 5 = 3 THEN 'ok'
    ELSE role || ' #' || cast(conv_id % 50 AS string) || ' – www.x.example/' || role END AS title,
  {body} AS selftext,
  'https://www.reddit.com/r/Sub' || {_K} || '/comments/' || cast(conv_id AS string) AS url,
  'Sub' || {_K} AS display_name, cast(NULL AS string) AS fullname, 's' || {_K} AS short_id,
  CASE WHEN conv_id % 4 = 0 THEN NULL ELSE 't5_s' || {_K} END AS subreddit_id,
  CASE WHEN role = 'system' OR conv_id % 9 = 0 THEN NULL
    ELSE role || cast(conv_id % 30 AS string) END AS author,
  cast(conv_id % 100 - 10 AS int) AS score, cast(turn AS int) AS num_comments,
  cast(1704067200.0 + conv_id * 3600 + turn * 60.5 AS double) AS created_utc,
  CASE WHEN conv_id % 2 = 0 THEN NULL ELSE 'flair' || cast(conv_id % 3 AS string) END
    AS link_flair_text,
  CASE (conv_id + {shift}) % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'zh-cn' ELSE 'fr' END AS lang_hint
  FROM conversations"""


_BODY = "CASE WHEN turn % 3 = 1 THEN '' ELSE text END"
RAW_POSTS = (
    _posts(0, "", _BODY)
    + " UNION ALL "
    + _posts(1, "x", f"CASE WHEN turn % 2 = 1 THEN {_BODY} ELSE '' END")
)

# An older list: one community was under another name then, one name under another id, one is not in it under either.
STORED_COMMUNITIES = f"""SELECT DISTINCT
  CASE conv_id % 5 WHEN 2 THEN 't5_other' WHEN 3 THEN 't5_gone' ELSE 't5_s' || {_K} END AS subreddit_id,
  CASE conv_id % 5 WHEN 1 THEN 'oldname' WHEN 3 THEN 'gone' ELSE 'sub' || {_K} END AS name
  FROM conversations"""

SOURCE_INPUTS = """SELECT page_id, CASE page_id % 9
  WHEN 0 THEN 'https://apps.apple.com/us/app/demo/id' || cast(100000 + page_id AS string)
  WHEN 1 THEN 'https://apps.apple.com/us/app/id' || cast(100000 + page_id AS string)
  WHEN 2 THEN 'ID' || cast(100000 + page_id AS string)
  WHEN 3 THEN cast(10000 + page_id AS string)
  WHEN 4 THEN 'https://www.reddit.com/r/Demo_' || cast(page_id AS string) || '/comments/AB' ||
    cast(page_id AS string) || '/t'
  WHEN 5 THEN 'https://reddit.com/r/Demo/'
  WHEN 6 THEN ' r/Demo'
  WHEN 7 THEN 'https://reddit.com/r/Demo?x=1'
  ELSE url END AS input FROM pages"""

# Apps by number and posts by an id without signs, as addresses name them, for batches that are asked for.
APP_NUMBER = "cast(100000 + ascii(substr(app_id, 2, 1)) * 10 + cast(right(app_id, 1) AS int) AS string)"
PLAIN_POST_ID = "replace(id, '_', 'z')"
# Apps in English and German, single posts, two communities, and what no form fits; some of them twice, some not landed.
REQUESTS = """SELECT page_id, CASE page_id % 5
  WHEN 0 THEN 'https://apps.apple.com/us/app/demo/id' || cast(101100 + page_id % 4 AS string)
  WHEN 1 THEN ' ID' || cast(101010 + page_id % 8 AS string)
  WHEN 2 THEN 'https://www.reddit.com/r/Any_' || cast(page_id AS string) || '/comments/' ||
    CASE WHEN page_id % 2 = 0 THEN 'X' ELSE '' END || cast(page_id AS string) || 'Z1/t'
  WHEN 3 THEN 'r/Sub' || cast(1 + 2 * (page_id % 2) AS string)
  ELSE url || '?' END AS input FROM pages"""

APP_DETAILS = """SELECT DISTINCT lang || '-' || cast(n_chars % 10 AS string) AS app_id,
  CASE WHEN n_chars % 10 < 3 THEN '' WHEN n_chars % 10 < 5 THEN NULL
    ELSE 'App ' || lang END AS app_name,
  CASE WHEN n_chars % 2 = 0 THEN NULL ELSE 'Other ' || lang END AS name FROM documents"""


class Inputs:
    """The raw batches of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A test table; each is one small file, hence shared out over the cores."""
        return spread(self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"), *KEYS.get(name, ()))

    def sql(self, query: str) -> DataFrame:
        """Run a query over the tables it names."""
        for name in ("documents", "conversations", "pages"):
            query = query.replace(f"FROM {name}", f"FROM {{{name}}}")
        used = {n: self.table(n) for n in ("documents", "conversations", "pages") if f"{{{n}}}" in query}
        return self.spark.sql(query, **used)

    def text(self, expression: str) -> DataFrame:
        """Document ids with a text made from the whole document."""
        return self.table("documents").selectExpr("doc_id", f"{expression} AS c")

    def reviews(self) -> DataFrame:
        return self.sql(RAW_REVIEWS)

    def later_reviews(self) -> DataFrame:
        return self.sql(RAW_REVIEWS_LATER)

    def posts(self) -> DataFrame:
        community = F.struct(
            "display_name", F.col("fullname"), F.col("short_id").alias("id")
        ).alias("subreddit")
        return self.sql(RAW_POSTS).select("*", community).drop(
            "display_name", "fullname", "short_id"
        )

    def source_inputs(self) -> DataFrame:
        return self.sql(SOURCE_INPUTS)

    def requests(self) -> DataFrame:
        return self.sql(REQUESTS)

    def numbered_reviews(self) -> DataFrame:
        return self.reviews().withColumn("app_id", F.expr(APP_NUMBER))

    def plain_posts(self) -> DataFrame:
        return self.posts().withColumn("id", F.expr(PLAIN_POST_ID))

    def app_details(self) -> DataFrame:
        return self.sql(APP_DETAILS)

    @staticmethod
    def language(text: str):
        return F.expr(REVIEW_LANGUAGE.format(text=text))
