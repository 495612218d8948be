"""Attach cleaned text and quality columns to a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_engine.functions.quality import preprocess_text
from feedback_engine.functions.text import clean_text
from feedback_engine.operators.langid import LanguageProfile


def attach_quality(
    df: DataFrame,
    text: str,
    titles: tuple[str, ...] = (),
    language: Column | LanguageProfile | None = None,
) -> DataFrame:
    """Replace ``text`` by its cleaned form and add the six quality columns.

    ``titles`` get surface cleaning only. ``language`` is a trained profile, a
    column holding codes found elsewhere, or nothing (all null).
    """
    kept = [c for c in df.columns if c not in (text, *titles)]
    prepared = df.select(
        *kept,
        *[clean_text(F.col(t)).alias(t) for t in titles],
        preprocess_text(F.col(text)).alias("_quality"),
    )
    cleaned = F.col("_quality.cleaned_text")
    if isinstance(language, LanguageProfile):
        code = language.detect(cleaned)
    elif language is None:
        code = F.lit(None).cast("string")
    else:
        code = language
    # Output columns stay in the order they came in, the new ones at the end.
    return prepared.select(
        *[cleaned.alias(c) if c == text else F.col(c) for c in df.columns],
        F.col("_quality.char_length").alias("cleaned_length"),
        F.col("_quality.word_count"),
        code.alias("language"),
        F.col("_quality.quality_score"),
        F.col("_quality.is_low_signal"),
        F.col("_quality.low_signal_reasons"),
    )
