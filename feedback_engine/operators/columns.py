"""Bring a DataFrame to a target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedback_engine.schemas import DEFAULTS, QUALITY


def missing_columns(df: DataFrame, required: tuple[str, ...]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """The same DataFrame, or ``ValueError`` naming what it lacks."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def _typed(df: DataFrame, field: T.StructField):
    present = field.name in df.columns
    value = (F.col(field.name) if present else F.lit(None)).cast(field.dataType)
    if field.name in DEFAULTS:
        value = F.coalesce(value, F.lit(DEFAULTS[field.name]).cast(field.dataType))
    return value.alias(field.name)


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns: absent ones added, all cast and ordered."""
    return df.select(*[_typed(df, f) for f in target.fields])


def backfill_quality(df: DataFrame) -> DataFrame:
    """All columns as they are, plus any quality column the writer left out."""
    names = QUALITY.fieldNames()
    return df.select(
        *[c for c in df.columns if c not in names], *[_typed(df, f) for f in QUALITY.fields]
    )
