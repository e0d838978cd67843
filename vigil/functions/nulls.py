"""Null / NaN aware predicates.

Spark and SQL treat NaN as a number larger than every other (``NaN >= 0`` is
true) and ``NULL >= 0`` as NULL. The checks here follow the pandas reading the
rules were written for instead: a missing value (null or NaN) never passes a
comparison, and a check result is never NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(_dtype(df, name), FLOATING)


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN on float/double columns."""
    c = F.col(name)
    if is_floating(df, name):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def present(df: DataFrame, name: str) -> Column:
    return ~is_missing(df, name)


def guarded(df: DataFrame, name: str, cond: Column) -> Column:
    """`cond` on column `name`, False when the value is missing; never NULL."""
    return F.coalesce(present(df, name) & cond, F.lit(False))


def nan_to_null(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Replace NaN and +/-Inf by NULL on float/double columns (JSON-safe)."""
    names = names or [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]
    out = []
    for f in df.schema.fields:
        if f.name in names and isinstance(f.dataType, FLOATING):
            c = F.col(f.name)
            bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
            out.append(F.when(bad, F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    """`dropna(subset=...)`: drops rows with null or NaN in any listed column."""
    return df.na.drop(subset=subset)
