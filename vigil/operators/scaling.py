"""Feature standardisation: (x - mean) / population std, per feature.

The means and deviations of all features come from one aggregate (a one-row
statistic) and are applied as literals, so the scaled frame is a narrow
projection of the input. A constant feature (std 0) is divided by 1. The
statistics are those of the finite values; an infinite value stays infinite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.profile import clean, finite


def scaler_aggs(df: DataFrame, features: list[str]) -> list:
    aggs = []
    for c in features:
        x = finite(df, c)
        aggs += [F.avg(x).alias(f"{c}__m"), F.stddev_pop(x).alias(f"{c}__s")]
    return aggs


def fit_scaler(df: DataFrame, features: list[str], row=None) -> dict[str, tuple[float, float]]:
    """Means and population deviations; `row` may hold `scaler_aggs` results already."""
    if row is None:
        row = df.agg(*scaler_aggs(df, features)).first()
    out = {}
    for c in features:
        m, s = row[f"{c}__m"], row[f"{c}__s"]
        out[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    cols = []
    for c in df.columns:
        if c in params:
            m, s = params[c]
            cols.append(((clean(df, c) - F.lit(m)) / F.lit(s)).alias(c + suffix))
            if suffix:
                cols.append(F.col(c))
        else:
            cols.append(F.col(c))
    return df.select(cols)


def standardize(df: DataFrame, features: list[str], suffix: str = "") -> DataFrame:
    return apply_scaler(df, fit_scaler(df, features), suffix)


def sql_standardize(src: str, features: list[str], keep: list[str]) -> str:
    """DuckDB twin: z-scores of `features` over complete rows of `src`."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in features)
    z = ", ".join(
        f"({c} - st.m_{c}) / CASE WHEN st.s_{c} IS NULL OR st.s_{c} = 0 THEN 1 ELSE st.s_{c} END AS {c}"
        for c in features)
    return f"SELECT {', '.join('b.' + k for k in keep)}, {z} FROM {src} b, (SELECT {stats} FROM {src}) st"
