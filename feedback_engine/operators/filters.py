"""Row filters. Each is ``DataFrame -> DataFrame`` for use with ``transform``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
RATING_RANGE = (1, 5)
STRONG_TITLE_CHARS = 10


def parse_language_list(text: str | None) -> list[str] | None:
    """``'en, zh,,'`` to ``['en', 'zh']``; nothing left means no list."""
    codes = [part.strip() for part in (text or "").split(",")]
    return [c for c in codes if c] or None


def language_list(text: Column) -> Column:
    """The same on a column of comma-separated codes."""
    codes = F.filter(F.transform(F.split(text, ","), lambda c: F.trim(c)), lambda c: c != "")
    return F.when(F.size(codes) > 0, codes)


def required_ok() -> Column:
    return F.col("rating").isNotNull() & F.col("timestamp").isNotNull()


def rating_ok() -> Column:
    return F.col("rating").between(*RATING_RANGE)


def review_not_empty() -> Column:
    return F.col("review_text") != ""


def post_not_empty() -> Column:
    return (F.col("title") != "") | (F.col("post_text") != "")


def language_ok(keep: Iterable[str] | None, primary_subtag: bool = False) -> Column:
    """Undetected languages always pass, and an empty list lets everything pass.

    With ``primary_subtag`` a listed ``zh`` also keeps ``zh-cn``.
    """
    codes = sorted({c.strip().lower() for c in keep or () if c and c.strip()})
    if not codes:
        return F.lit(True)
    language = F.lower("language")
    listed = language.isin(codes)
    if primary_subtag:
        listed = listed | F.substring_index(language, "-", 1).isin(codes)
    return F.col("language").isNull() | listed


def score_ok(min_quality: float | None) -> Column:
    if min_quality is None:
        return F.lit(True)
    if not 0.0 <= min_quality <= 1.0:
        raise ValueError("min_quality must be between 0.0 and 1.0")
    return F.coalesce(F.col("quality_score") >= F.lit(float(min_quality)), F.lit(False))


def review_signal_ok(drop_low_signal: bool = True) -> Column:
    return F.col("is_low_signal") == 0 if drop_low_signal else F.lit(True)


def post_signal_ok(drop_low_signal: bool = True) -> Column:
    """A strong title rescues a post whose body says little."""
    if not drop_low_signal:
        return F.lit(True)
    return (F.col("is_low_signal") == 0) | (F.length("title") >= STRONG_TITLE_CHARS)


def filter_required(df: DataFrame) -> DataFrame:
    return df.filter(required_ok())


def filter_rating_range(df: DataFrame) -> DataFrame:
    return df.filter(rating_ok())


def filter_empty_review(df: DataFrame) -> DataFrame:
    return df.filter(review_not_empty())


def filter_empty_post(df: DataFrame) -> DataFrame:
    return df.filter(post_not_empty())


def filter_language(df: DataFrame, keep: Iterable[str] | None, primary_subtag: bool = False):
    return df.filter(language_ok(keep, primary_subtag))


def filter_min_quality(df: DataFrame, min_quality: float | None) -> DataFrame:
    return df.filter(score_ok(min_quality))


def filter_low_signal_reviews(df: DataFrame) -> DataFrame:
    return df.filter(review_signal_ok())


def filter_low_signal_posts(df: DataFrame) -> DataFrame:
    return df.filter(post_signal_ok())


def optional_filters(
    kind: str,
    *,
    drop_low_signal: bool = False,
    min_quality: float | None = None,
    keep_languages: Iterable[str] | None = None,
    primary_subtag: bool = False,
) -> dict[str, Column]:
    """The filters a caller may switch on, in the order they apply."""
    signal = review_signal_ok if kind == "reviews" else post_signal_ok
    return {
        "language": language_ok(keep_languages, primary_subtag),
        "min_quality": score_ok(min_quality),
        "low_signal": signal(drop_low_signal),
    }


def apply_quality_filters(df: DataFrame, kind: str, **options) -> DataFrame:
    """All optional filters of ``reviews`` or ``posts``."""
    for predicate in optional_filters(kind, **options).values():
        df = df.filter(predicate)
    return df
