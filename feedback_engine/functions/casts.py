"""Casts and defaults that turn landed strings into typed columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedback_engine.functions.let import let

# --- fixed values --------------------------------------------------------------

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
ANONYMOUS = "Anonymous"
DELETED = "[deleted]"
COMMUNITY_PREFIX = "t5_"
APP_NAME_PREFIX = "AppId_"

_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
_HAS_DATE = r"^\s*\d{4}-\d"
_WEEKDAY = r"^(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,\s*"
_ZONE = r"(?<=:\d\d )([A-Za-z]{1,3})$"
_ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600",
    "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
_TIME = "[ h:mm[:ss] a][ H:mm[:ss]]"
_OTHER_FORMATS = (f"yyyy/M/d{_TIME}", "yyyyMMdd", *(f"{day}{_TIME}" for day in ("MMM d, yyyy", "MMMM d, yyyy")),
                  *(f"d {month} yyyy{rest}" for month in ("MMM", "MMMM") for rest in (" H:mm[:ss] Z", _TIME)))
# What parse_timestamp_utc tries after ISO, in order. They differ in which of 01/05/2024 is the month.
MONTH_FIRST = (f"M/d/yyyy{_TIME}", *_OTHER_FORMATS)
DAY_FIRST = (f"d/M/yyyy{_TIME}", *_OTHER_FORMATS)
_NUMERIC_DATE = r"^\s*(\d{1,2})/(\d{1,2})/\d{4}"
_UNICODE_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def strip_edges(text: Column) -> Column:
    """Remove white space of any script at both ends."""
    return F.regexp_replace(text, _UNICODE_EDGES, "")


def cast_rating(rating: Column) -> Column:
    """Number text to a truncated integer; anything else is null.

    Spark would also read ``4d`` and ``NaN`` as doubles, hence the pattern.
    """
    number = F.when(rating.cast("string").rlike(_NUMBER), rating.cast("string"))
    return number.try_cast("double").try_cast("int")


def parse_timestamp_utc(
    text: Column, formats: Sequence[str] = MONTH_FIRST, day_first: Column | None = None
) -> Column:
    """ISO-like text, or else text of the first of ``formats`` that fits, to a timestamp in whole seconds; anything else is null.

    Offsets are honoured, and text without one is UTC (the session zone). The
    day's name before a date says nothing new and is not looked at.
    Time-only text is refused: Spark would fill in today's date. Where
    ``day_first`` is true, formats that start with the month are read as
    starting with the day.
    """
    dated = F.when(text.rlike(_HAS_DATE), F.trim(text))
    others = let(F.regexp_replace(F.trim(text), _WEEKDAY, ""), lambda bare: let(
        _offset_for_zone(bare), lambda plain: _first_fitting(plain, formats, day_first)
    ))
    return F.date_trunc("second", F.coalesce(dated.try_cast("timestamp"), others))


def _offset_for_zone(bare: Column) -> Column:
    """The text with the name of a zone after a time replaced by its offset."""
    offsets = F.create_map(*[F.lit(x) for pair in _ZONES.items() for x in pair])
    offset = F.try_element_at(offsets, F.upper(F.regexp_extract(bare, _ZONE, 1)))
    return F.coalesce(F.concat(F.regexp_replace(bare, _ZONE, ""), offset), bare)


def _first_fitting(plain: Column, formats: Sequence[str], day_first: Column | None) -> Column:
    """A format is only tried on text of its shape: a failed attempt costs an exception."""

    def read(form: str) -> Column:
        parsed = F.try_to_timestamp(plain, F.lit(form))
        if day_first is not None and form.startswith("M/d/"):
            turned = F.try_to_timestamp(plain, F.lit("d/M/" + form.removeprefix("M/d/")))
            parsed = F.when(day_first, turned).otherwise(parsed)
        return F.when(plain.rlike(_shape(form)), parsed)

    return F.coalesce(*map(read, formats)) if formats else F.lit(None).cast("timestamp")


def _shape(form: str) -> str:
    """A pattern for how text of a date format starts, up to its first optional part."""

    def field(m: re.Match) -> str:
        letter, size = m.group()[0], len(m.group())
        if letter == "M" and size > 2 or letter not in "yMdHhmsS":
            return r"\S+"
        return rf"\d{{{size}}}" if size > 1 else r"\d{1,9}"

    return "^" + re.sub(r"([A-Za-z])\1*", field, form.split("[")[0])


def day_first_evidence(text: Column) -> Column:
    """1 where a date in numbers can only have the day first, -1 where only the month, 0 elsewhere."""
    first, second = (F.regexp_extract(text, _NUMERIC_DATE, k).try_cast("int") for k in (1, 2))
    return F.when((first > 12) & (second <= 12), 1).when((first <= 12) & (second > 12), -1).otherwise(0)


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a timestamp, fraction cut off."""
    return F.timestamp_seconds(F.floor(seconds))


def timestamp_text(timestamp: Column) -> Column:
    """The text form keys are built from."""
    return F.date_format(timestamp, TIMESTAMP_FORMAT)


def review_author(name: Column) -> Column:
    """Null becomes a placeholder; a blank name stays, as the empty string."""
    return strip_edges(F.coalesce(name, F.lit(ANONYMOUS)))


def post_author(name: Column) -> Column:
    """Null and empty become the deleted-account placeholder."""
    return F.coalesce(_blank_to_null(name), F.lit(DELETED))


def community_id(own_id: Column, full_name: Column, short_id: Column) -> Column:
    """First non-empty of the post's own id, the full name, the prefixed short id."""
    prefixed = F.concat(F.lit(COMMUNITY_PREFIX), _blank_to_null(short_id))
    return F.coalesce(_blank_to_null(own_id), _blank_to_null(full_name), prefixed, F.lit(""))


def app_name(name: Column, other_name: Column, app_id: Column) -> Column:
    """First non-empty of the two names, else one made from the id."""
    return F.coalesce(
        _blank_to_null(name), _blank_to_null(other_name), F.concat(F.lit(APP_NAME_PREFIX), app_id)
    )


def empty_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
