"""Stable keys, so that repeated runs meet the same rows again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedback_engine.functions.casts import strip_edges

# Separator and length of the text part of a review key.
KEY_SEPARATOR = "|"
KEY_TEXT_CHARS = 100


def review_key(app_id: Column, user: Column, timestamp_text: Column, text: Column) -> Column:
    """SHA-256 of app, user, time and the first characters of the text; nulls count as empty.

    Every part keeps its place, so rows that lack different parts have different keys.
    """
    app_id, user, timestamp_text, text = (
        F.coalesce(part, F.lit("")) for part in (app_id, user, timestamp_text, text)
    )
    head = F.substring(strip_edges(text), 1, KEY_TEXT_CHARS)
    return F.sha2(F.concat_ws(KEY_SEPARATOR, app_id, user, timestamp_text, head), 256)


def user_id(platform: Column, username: Column) -> Column:
    """SHA-256 of platform and name; null for a null name."""
    return F.sha2(F.concat(platform, F.lit(KEY_SEPARATOR), username), 256)


def text_digest(*texts: Column) -> Column:
    """32 bytes standing for whole texts where rows are only compared or counted.

    Lengths go in first, so that no two different lists of texts share a form.
    """
    parts = [p for t in texts for p in (F.length(t).cast("string"), t)]
    return F.unhex(F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256))
