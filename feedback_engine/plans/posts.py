"""The post pipeline: landed submissions to rows ready to store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from feedback_engine.operators import filters, stages
from feedback_engine.operators.dedup import bounded_fetch, dedup_posts
from feedback_engine.operators.langid import LanguageProfile
from feedback_engine.operators.quality import attach_quality
from feedback_engine.sources.landing import scan_post_by_id, scan_posts

Language = Column | LanguageProfile | None


def clean_posts(landed: DataFrame, language: Language = None, limit: int | None = None):
    """Flatten, clean and score; ``limit`` bounds rows per community."""
    posts = scan_posts(landed)
    if limit is not None:
        posts = bounded_fetch(posts, "subreddit_id", limit)
    return posts.transform(attach_quality, "post_text", ("title",), language)


def post_pipeline(
    landed: DataFrame, language: Language = None, limit: int | None = None, **options
) -> DataFrame:
    """Cleaned, de-duplicated and filtered posts."""
    return select_posts(clean_posts(landed, language, limit), **options)


def select_posts(cleaned: DataFrame, **options) -> DataFrame:
    """The part of the pipeline that follows cleaning.

    As for reviews, filters on what follows from title and body run before the
    de-duplication on title and body.
    """
    chosen = filters.optional_filters("posts", **options)
    return (
        cleaned.transform(filters.filter_empty_post)
        .filter(chosen["min_quality"])
        .filter(chosen["low_signal"])
        .transform(dedup_posts)
        .filter(chosen["language"])
    )


def post_by_id(landed: DataFrame, post_id: str, language: Language = None, **options) -> DataFrame:
    """One post, cleaned and filtered; there is nothing to de-duplicate."""
    return _chosen(scan_post_by_id(landed, post_id), language, **options)


def chosen_posts(landed: DataFrame, language: Language = None, **options) -> DataFrame:
    """Posts that were each asked for, cleaned and filtered; copies stay."""
    return _chosen(scan_posts(landed), language, **options)


def _chosen(posts: DataFrame, language: Language, **options) -> DataFrame:
    return (
        posts.transform(attach_quality, "post_text", ("title",), language)
        .transform(filters.filter_empty_post)
        .transform(filters.apply_quality_filters, "posts", **options)
    )


def post_stage_counts(cleaned: DataFrame, **options) -> DataFrame:
    """Row counts per community for every stage after cleaning."""
    chosen = {"empty": filters.post_not_empty(), **filters.optional_filters("posts", **options)}
    return stages.stage_counts(cleaned, "subreddit_id", "author", ("title", "post_text"), chosen)
