"""Bind a computed column to a name inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used.

    Spark inlines a column wherever it is mentioned. A text-cleaning chain that
    is mentioned five times would run five times, so it is bound through the
    lambda of a one-element ``transform``.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
