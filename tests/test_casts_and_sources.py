import pytest
from pyspark.sql import functions as F

from feedback_engine.functions import casts, dispatch, keys
from feedback_engine.operators import columns
from feedback_engine.schemas import POSTS, RAW_POST, RAW_REVIEW
from feedback_engine.sources import landing


def test_rating(apply):
    raw = ["4.7", "0.5", "5.9", "x", " 3 ", "NaN", "inf", "4d", "1e20", None, "-0.5", "1e0"]
    assert apply(casts.cast_rating, raw) == [4, 0, 5, None, 3, None, None, None, None, None, 0, 1]


def test_timestamp(apply):
    raw = ["2024-01-02 03:04:05.9", "2024-01-02T03:04:05+02:00", "2024-01-02", "nope", "12:30", None,
           "2024-13-01", "2024-01-02T03:04:05Z"]
    got = apply(lambda c: casts.timestamp_text(casts.parse_timestamp_utc(c)), raw)
    assert got == ["2024-01-02 03:04:05", "2024-01-02 01:04:05", "2024-01-02 00:00:00", None, None,
                   None, None, "2024-01-02 03:04:05"]


def test_epoch_is_cut(apply):
    got = apply(lambda c: casts.timestamp_text(casts.epoch_to_timestamp(c)), [1704067200.9], "double")
    assert got == ["2024-01-01 00:00:00"]


def test_authors(apply):
    assert apply(casts.review_author, [None, "  ", " u1 "]) == ["Anonymous", "", "u1"]
    assert apply(casts.post_author, [None, "", "u1"]) == ["[deleted]", "[deleted]", "u1"]


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("https://apps.apple.com/us/app/demo/id123456", "APPLE", "123456"),
        ("https://apps.apple.com/us/app/demo/id1234567890123", "APPLE", "123456789012"),
        ("https://apps.apple.com/us/app/id123456", None, None),
        (" ID123456 ", "APPLE", "123456"),
        ("123456", "APPLE", "123456"),
        ("12345", "REDDIT_SUBREDDIT", "12345"),
        ("https://www.reddit.com/r/Py/comments/AB1/t", None, None),
        ("https://www.reddit.com/r/Demo/comments/AB1/t", "REDDIT_POST", "ab1"),
        ("https://reddit.com/r/Demo/", "REDDIT_SUBREDDIT", "demo"),
        ("https://reddit.com/r/Demo?x=1", None, None),
        ("r/Demo", "REDDIT_SUBREDDIT", "demo"),
        ("", None, None),
    ],
)
def test_dispatch(apply, text, kind, value):
    row = apply(dispatch.classify_source, [text])[0]
    assert (row.kind, row.value) == (kind, value)


def test_review_key_is_plain_sha256(spark):
    import hashlib

    text = " é" + "x" * 200
    row = spark.createDataFrame([("a", "u", "2024-01-01 00:00:00", text)], "a string, u string, t string, r string")
    got = row.select(keys.review_key(*map(F.col, "autr"))).first()[0]
    raw = f"a|u|2024-01-01 00:00:00|{text.strip()[:100]}"
    assert got == hashlib.sha256(raw.encode()).hexdigest()


def test_nulls_keep_their_place_in_review_keys(spark):
    parts = [(None, "a", "b", "t"), ("a", "b", None, "t"), ("a", None, "b", "t"), ("a", "b", "t", None)]
    rows = spark.createDataFrame(parts, "a string, u string, t string, r string")
    assert rows.select(keys.review_key(*map(F.col, "autr"))).distinct().count() == len(parts)


def test_missing_columns(spark):
    landed = spark.createDataFrame([], RAW_REVIEW).drop("title")
    with pytest.raises(ValueError, match="title"):
        landing.scan_reviews(landed)
    empty = landing.scan_reviews(landed, on_missing="empty")
    assert empty.count() == 0 and "review_text" in empty.columns
    with pytest.raises(ValueError, match="post_id"):
        columns.require_columns(landed, ("post_id",))


def test_json_lines_keep_good_records(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"arrival_seq":1,"rating":4,"review":"a"}\n{"arrival_seq":2,"ra\n\n  \n{}\nnull\n')
    parsed = landing.parse_json_lines(spark.read.text(str(tmp_path)), RAW_REVIEW)
    good, bad = landing.split_corrupt(parsed)
    assert [(r.arrival_seq, r.rating) for r in good.collect()] == [(1, "4")]
    found = sorted((r.reason, r[0].strip()) for r in bad.collect())
    assert found == [("blank", ""), ("blank", ""), ("broken", "null"), ("broken", '{"arrival_seq":2,"ra'), ("broken", "{}")]
    assert landing.read_landed(spark, str(tmp_path), RAW_REVIEW, "json").records.count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_columnar_landing(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    rows = [(1, "a", "u", "5", "t", "2024-01-01", "text")]
    spark.createDataFrame(rows, RAW_REVIEW).write.format(fmt).save(path)
    assert landing.read_landed(spark, path, RAW_REVIEW, fmt).records.count() == 1


def test_post_by_id_is_pushed_to_the_scan(spark, tmp_path):
    from tests.conftest import plan_of

    path = str(tmp_path / "posts")
    spark.createDataFrame([], RAW_POST).write.parquet(path)
    plan = plan_of(landing.scan_post_by_id(landing.read_landed(spark, path, RAW_POST).records, "p1"))
    assert "EqualTo(id,p1)" in plan


def test_community_fallbacks(spark):
    rows = [("t5_a", "t5_b", "c"), (None, "t5_b", "c"), ("", None, "c"), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(casts.community_id(*map(F.col, "abc"))).collect()]
    assert got == ["t5_a", "t5_b", "t5_c", ""]


def test_align_schema_fills_defaults(spark):
    row = columns.align_schema(spark.range(1).select(F.lit("p").alias("post_id")), POSTS).first()
    assert row.post_id == "p" and row.is_low_signal == 0 and row.quality_score is None
