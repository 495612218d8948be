"""The review pipeline: landed records to rows ready to store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_engine.functions.casts import MONTH_FIRST
from feedback_engine.operators import filters, stages
from feedback_engine.operators.dedup import bounded_fetch, dedup_reviews
from feedback_engine.operators.langid import LanguageProfile
from feedback_engine.operators.quality import attach_quality
from feedback_engine.sources.landing import scan_reviews, typed_reviews

Language = Column | LanguageProfile | None


def clean_reviews(
    landed: DataFrame,
    language: Language = None,
    count: int | None = None,
    dates: Sequence[str] | str = MONTH_FIRST,
) -> DataFrame:
    """Cast, drop unusable rows, clean and score.

    ``count`` bounds rows per app; ``dates`` are forms beside ISO, or ``landing.VOTE``.
    """
    reviews = scan_reviews(landed)
    if count is not None:
        reviews = bounded_fetch(reviews, "app_id", count)
    return (
        typed_reviews(reviews, dates)
        .transform(filters.filter_required)
        .transform(filters.filter_rating_range)
        .transform(attach_quality, "review_text", ("title",), language)
        .transform(filters.filter_empty_review)
    )


def review_pipeline(
    landed: DataFrame,
    language: Language = None,
    count: int | None = None,
    dates: Sequence[str] | str = MONTH_FIRST,
    **options,
) -> DataFrame:
    """Cleaned, de-duplicated and filtered reviews."""
    return select_reviews(clean_reviews(landed, language, count, dates), **options)


def select_reviews(cleaned: DataFrame, **options) -> DataFrame:
    """The part of the pipeline that follows cleaning.

    Score and low-signal flag follow from the text, which is part of the
    de-duplication key: all copies pass or fail together. Those two filters
    therefore run first, which gives the same rows and a smaller shuffle.
    """
    chosen = filters.optional_filters("reviews", **options)
    return (
        cleaned.filter(chosen["min_quality"])
        .filter(chosen["low_signal"])
        .transform(dedup_reviews)
        .filter(chosen["language"])
    )


def review_stage_counts(cleaned: DataFrame, **options) -> DataFrame:
    """Row counts per app for every stage after cleaning."""
    chosen = filters.optional_filters("reviews", **options)
    return stages.stage_counts(cleaned, "app_id", "userName", ("review_text",), chosen)


def review_stages(landed: DataFrame, language: Language = None, **options) -> DataFrame:
    """Raw, cleaned and final row counts per app."""
    counts = review_stage_counts(clean_reviews(landed, language), **options)
    return stages.stage_comparison(landed.select(F.col("app_id")), counts, "app_id")
