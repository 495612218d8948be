import pytest
from pyspark.sql import functions as F

from feedback_engine.functions import casts
from feedback_engine.operators import filters
from feedback_engine.plans.reviews import review_pipeline
from feedback_engine.schemas import RAW_REVIEW
from feedback_engine.sources import landing

MIDNIGHT = "2024-01-05 00:00:00"
FORMS = {
    "Jan 5, 2024": MIDNIGHT, "January 5, 2024": MIDNIGHT, "01/05/2024": MIDNIGHT, "1/5/2024 3:04 PM": "2024-01-05 15:04:00",
    "2024/01/05": MIDNIGHT, "2024/01/05 03:04:05": "2024-01-05 03:04:05", "20240105": MIDNIGHT, "5 Jan 2024": MIDNIGHT,
    "Fri, 05 Jan 2024 03:04:05 +0200": "2024-01-05 01:04:05", "Fri, 5 Jan 2024 03:04:05 GMT": "2024-01-05 03:04:05",
    "5 Jan 2024 03:04 EST": "2024-01-05 08:04:00", "2024-01-05": MIDNIGHT,
    "13/01/2024": None, "20241305": None, "Foo 5, 2024": None, "12:30": None, "3:04 PM": None, "2024": None, "": None,
}


def test_forms_of_dates(apply):
    assert dict(zip(FORMS, apply(lambda c: casts.timestamp_text(casts.parse_timestamp_utc(c)), list(FORMS)))) == FORMS


def test_the_caller_chooses_the_order_of_day_and_month(apply):
    def rule(c):
        return casts.timestamp_text(casts.parse_timestamp_utc(c, casts.DAY_FIRST))

    assert apply(rule, ["01/05/2024", "13/01/2024"]) == ["2024-05-01 00:00:00", "2024-01-13 00:00:00"]


@pytest.mark.parametrize("date", ["Jan 5, 2024", "01/05/2024", "2024/01/05", "20240105", "Fri, 05 Jan 2024 00:00:00 +0000"])
def test_reviews_are_kept(spark, date):
    landed = spark.createDataFrame([(1, "a", "u", "5", "t", date, "text")], RAW_REVIEW)
    kept = filters.filter_required(landing.typed_reviews(landing.scan_reviews(landed)))
    assert [r.t for r in kept.select(casts.timestamp_text(F.col("timestamp")).alias("t")).collect()] == [MIDNIGHT]
    day_first = review_pipeline(landed, dates=casts.DAY_FIRST)
    assert day_first.count() == 1


def landed_dates(spark, *apps):
    rows = [(k, app, "u", "5", "t", date, f"text {k}") for k, (app, date) in enumerate(apps)]
    return spark.createDataFrame(rows, RAW_REVIEW)


@pytest.mark.parametrize("named", [1000, 0])
def test_each_source_votes(spark, monkeypatch, named):
    """By names in the plan and by a join alike."""
    monkeypatch.setattr(landing, "NAMED_SOURCES", named)
    landed = landed_dates(
        spark, ("day", "13/01/2024"), ("day", "05/01/2024"), ("month", "01/13/2024"), ("month", "05/01/2024"),
        ("tie", "13/01/2024"), ("tie", "01/13/2024"), ("open", "05/01/2024"), (None, "14/01/2024"), (None, "05/01/2024"),
        ("day", "Jan 5, 2024"), ("day", "2024-01-05"), ("day", None),
    )
    typed = landing.typed_reviews(landing.scan_reviews(landed), landing.VOTE)
    assert typed.columns == landing.scan_reviews(landed).columns
    shown = typed.orderBy("arrival_seq").select(F.date_format("timestamp", "MM-dd").alias("t")).collect()
    assert [r.t for r in shown] == [
        "01-13", "01-05", "01-13", "05-01", None, "01-13", "05-01", "01-14", "01-05", "01-05", "01-05", None
    ]
    assert review_pipeline(landed, dates=landing.VOTE).count() == 10
    assert review_pipeline(landed).count() == 8


def test_no_generated_code_grows_too_large(spark, capfd):
    """The engine's own query over all forms of dates; a class too large is logged as an error and interpreted."""
    from feedback_engine import catalog

    for name in ("filter_required", "parse_timestamp_utc", "upsert_reviews"):
        catalog.queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert "CodeGenerator" not in capfd.readouterr().err
