"""Recognise which feedback source a user-supplied name, id or address means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedback_engine.functions.casts import strip_edges
from feedback_engine.functions.let import let

# --- fixed values: source kinds and the accepted forms (lower-cased input) -----

APP = "APPLE"
POST = "REDDIT_POST"
COMMUNITY = "REDDIT_SUBREDDIT"

APP_URL = r"apps\.apple\.com/[^\n]*/app/[^\n]*/id(\p{Nd}{6,12})"
APP_ID = r"^(?:id)?(\p{Nd}{6,12})$"
POST_URL = r"reddit\.com/r/[A-Za-z0-9_]{3,21}/comments/([A-Za-z0-9]+)"
COMMUNITY_URL = r"reddit\.com/r/([A-Za-z0-9_]{3,21})(?:/|$)"
COMMUNITY_NAME = r"^(?:r/)?([A-Za-z0-9_]{3,21})$"

# Tried in this order; the first form that fits decides.
RULES = (
    (APP, APP_URL),
    (APP, APP_ID),
    (POST, POST_URL),
    (COMMUNITY, COMMUNITY_URL),
    (COMMUNITY, COMMUNITY_NAME),
)


def fold_input(text: Column) -> Column:
    return F.lower(strip_edges(text))


def extract(folded: Column, form: str) -> Column:
    """The value a form holds, null where the form does not fit."""
    return F.nullif(F.regexp_extract(folded, form, 1), F.lit(""))


def _tagged(kind: str, value: Column) -> Column:
    return let(
        value,
        lambda v: F.when(v.isNotNull(), F.struct(F.lit(kind).alias("kind"), v.alias("value"))),
    )


def classify_source(text: Column) -> Column:
    """Struct of kind and value; both null when no form fits."""

    def first_match(folded: Column) -> Column:
        found = [_tagged(kind, extract(folded, form)) for kind, form in RULES]
        nothing = F.struct(
            F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("value")
        )
        return F.coalesce(*found, nothing)

    return let(fold_input(text), first_match)
