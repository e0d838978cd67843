"""Text formatting for report fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def currency(c: Column | str) -> Column:
    """`$1,234.56`, minus sign before the dollar for negatives."""
    c = F.col(c) if isinstance(c, str) else c
    body = F.concat(F.lit("$"), F.format_number(F.abs(c), 2))
    return F.when(c < 0, F.concat(F.lit("-"), body)).otherwise(body)


def label_text(c: Column | str, positive: str = "FRAUD", negative: str = "Normal") -> Column:
    """1 -> positive label, anything else -> negative label."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == 1, F.lit(positive)).otherwise(F.lit(negative))
