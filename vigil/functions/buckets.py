"""Labelled range buckets (a chained CASE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amount-range cuts and labels of the distribution report.
AMOUNT_CUTS = [10, 50, 100, 500, 1000, 5000]
AMOUNT_LABELS = ["$0-10", "$10-50", "$50-100", "$100-500", "$500-1K", "$1K-5K", "$5K+"]


def bucketize(c: Column | str, cuts=AMOUNT_CUTS, labels=AMOUNT_LABELS, null_label: str | None = None) -> Column:
    """First label whose upper cut is above the value (`<`), else the last label.

    NULL matches no cut and lands in the last label, as a SQL CASE does; pass
    `null_label` to give missing values their own bucket.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cuts")
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for cut, label in zip(cuts, labels[:-1]):
        expr = F.when(c < cut, label) if expr is None else expr.when(c < cut, label)
    expr = expr.otherwise(labels[-1])
    if null_label is not None:
        expr = F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(null_label)).otherwise(expr)
    return expr


def sql_bucketize(expr: str, cuts=AMOUNT_CUTS, labels=AMOUNT_LABELS) -> str:
    whens = " ".join(f"WHEN {expr} < {cut} THEN '{label}'" for cut, label in zip(cuts, labels[:-1]))
    return f"CASE {whens} ELSE '{labels[-1]}' END"
