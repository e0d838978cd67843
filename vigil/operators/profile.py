"""Column profiles: category counts, numeric describe, range/mean, histogram,
box-plot statistics, and exact quantiles that scale.

Missing values (null, and NaN on float columns) are skipped by every
statistic, as pandas does. One-row statistics are brought to the driver and
used as literals; no statistic joins or crosses back onto the data. Exact
quantiles take two scans: a sketch that brackets the ranks, and a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vigil.functions.nulls import is_floating
from vigil.session import scratch_dir

ACCURACY = 10_000       # of the quantile sketch: a rank is off by at most n / ACCURACY
MARGIN = 3 / ACCURACY   # of a bracket on either side of its rank
PART_VALUES = 100_000   # distinct values that one task puts in order


def clean(df: DataFrame, c: str) -> Column:
    """Column `c` as double with NaN turned into NULL."""
    x = F.col(c)
    if is_floating(df, c):
        x = F.when(F.isnan(x), F.lit(None)).otherwise(x)
    return x.cast("double")


def category_counts(df: DataFrame, c: str) -> DataFrame:
    """value_counts: non-null values with their count, most frequent first."""
    known = F.col(c).isNotNull() & ~F.isnan(c) if is_floating(df, c) else F.col(c).isNotNull()
    return (df.where(known).groupBy(c)
              .agg(F.count(F.lit(1)).cast("long").alias("n"))
              .orderBy(F.desc("n"), F.asc(c)))


# ---------------------------------------------------------------- quantiles
def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the columns of a number type, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _interpolate(vlo: float, vhi: float, frac: float) -> float:
    return vlo if vlo == vhi else vlo + (vhi - vlo) * frac  # equal infinite neighbours have no difference


def _marks(probs: list[float]) -> list[float]:
    return sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-MARGIN, MARGIN)})


def sketch_aggs(df: DataFrame, cols: list[str], probs: list[float]) -> list[Column]:
    """Per column its count, bounds, and the quantile sketch at the ends of the bracket of each probability."""
    out = []
    for i, c in enumerate(cols):
        x = clean(df, c)
        out += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.percentile_approx(x, _marks(probs), ACCURACY).alias(f"at{i}")]
    return out


def _brackets(row, i: int, probs: list[float]) -> list[tuple[float, float]]:
    """Disjoint intervals, in order, that hold the values at the probabilities of column i."""
    found = dict(zip(_marks(probs), row[f"at{i}"]))
    out: list[tuple[float, float]] = []
    for p in sorted(set(probs)):
        low, high = found[min(max(p - MARGIN, 0.0), 1.0)], found[min(max(p + MARGIN, 0.0), 1.0)]
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _cells(df: DataFrame, cols: list[str], brackets: list[list[tuple[float, float]]]) -> DataFrame:
    """(g, cell, v, n, mn, mx): how many values of column g lie in each cell, per value v inside a bracket.

    Cell 2j lies under bracket j, cell 2j + 1 is bracket j. One scan of all
    columns; a value that many rows share, and all that lies between the
    brackets, is added up before the shuffle.
    """
    each = []
    for g, (c, own) in enumerate(zip(cols, brackets)):
        x = clean(df, c)
        cell = sum(((x >= F.lit(a)).cast("int") + (x > F.lit(b)).cast("int") for a, b in own), F.lit(0))
        each.append(F.struct(F.lit(g).alias("g"), cell.alias("cell"), x.alias("x")))
    values = df.select(F.inline(F.array(*each))).where(F.col("x").isNotNull())
    value = F.when(F.col("cell") % 2 == 1, F.col("x"))
    return values.groupBy("g", "cell", value.alias("v")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"))


def _ranked(cells: DataFrame, wanted: list[tuple[int, int, int]], distinct: int) -> dict[tuple[int, int, int], float]:
    """The values at the ranks (g, cell, r) within their brackets.

    The distinct values are dealt out in order, about `PART_VALUES` to a task;
    a rank is found by the totals of the parts first, then inside its part.
    """
    spark = cells.sparkSession
    parts = max(1, -(-distinct // PART_VALUES))
    placed = cells.where("cell % 2 = 1").select("g", "cell", "v", "n", F.lit(0).alias("part"))
    targets = [(g, cell, 0, r, r) for g, cell, r in wanted]
    if parts > 1:  # one part needs no dealing out
        path = scratch_dir(spark, "brackets")
        placed.repartitionByRange(parts, "g", "cell", "v").withColumn("part", F.spark_partition_id()).write.parquet(path)
        placed = spark.read.parquet(path)
        totals: dict[tuple[int, int], list] = {}
        for row in placed.groupBy("g", "cell", "part").agg(F.sum("n").alias("n")).orderBy("part").collect():
            totals.setdefault((row["g"], row["cell"]), []).append(row)
        targets = []
        for g, cell, r in wanted:
            left = r
            for row in totals[(g, cell)]:
                if left < row["n"]:
                    targets.append((g, cell, row["part"], r, left))
                    break
                left -= row["n"]
    upto = F.sum("n").over(Window.partitionBy("g", "cell", "part").orderBy("v"))
    at = spark.createDataFrame(targets, "g int, cell int, part int, r long, left_over long")
    found = (placed.withColumn("upto", upto).join(F.broadcast(at), ["g", "cell", "part"])
                   .where((F.col("left_over") < F.col("upto")) & (F.col("left_over") >= F.col("upto") - F.col("n"))))
    return {(row["g"], row["cell"], row["r"]): row["v"] for row in found.collect()}


def neighbours_many(df: DataFrame, cols: list[str], probs: list[float], row=None) -> dict[str, tuple[int, list]]:
    """Per column (n, [(x_i, x_i+1, frac) per probability]): the exact values around each rank p * (n - 1).

    Two scans, whatever the data and the number of columns. The first fits a
    mergeable quantile sketch (`row`, if the caller's aggregate holds
    `sketch_aggs` already), which brackets every rank. The second counts what
    lies between the brackets and each value inside; the few values inside are
    put in order apart. A rank next to a bracket is the end of a gap. Should a
    sketch ever miss its bound by more, the gap is taken as the next bracket.
    """
    if row is None:
        row = df.agg(*sketch_aggs(df, cols, probs)).first()
    out: dict[str, tuple[int, list]] = {c: (0, [None for _ in probs]) for c in cols}
    plans, brackets = {}, [[] for _ in cols]
    for g, c in enumerate(cols):
        if row[f"n{g}"]:
            brackets[g] = _brackets(row, g, probs)
            plans[g] = [(int(pos // 1), min(int(pos // 1) + 1, row[f"n{g}"] - 1), pos - pos // 1) for pos in (p * (row[f"n{g}"] - 1) for p in probs)]
    got: dict[tuple[int, int], float] = {}
    open_ranks = {(g, k) for g, plan in plans.items() for i, j, _ in plan for k in (i, j)}
    while open_ranks:
        path = scratch_dir(df.sparkSession, "cells")
        _cells(df, cols, brackets).write.parquet(path)
        cells = df.sparkSession.read.parquet(path)
        sums = sorted(cells.groupBy("g", "cell").agg(F.sum("n").alias("n"), F.min("mn").alias("mn"), F.max("mx").alias("mx"), F.count(F.lit(1)).alias("d")).collect())
        wanted, missed = {}, {}
        for g, k in open_ranks:
            left = k
            for s in (s for s in sums if s["g"] == g):
                if left < s["n"]:
                    if s["cell"] % 2:
                        wanted[(g, s["cell"], left)] = k
                    elif left == 0 or left == s["n"] - 1 or s["mn"] == s["mx"]:
                        got[(g, k)] = s["mn"] if left == 0 else s["mx"]
                    else:
                        missed[(g, k)] = (s["mn"], s["mx"])
                    break
                left -= s["n"]
        if wanted:
            for key, v in _ranked(cells, list(wanted), sum(s["d"] for s in sums if s["cell"] % 2)).items():
                got[(key[0], wanted[key])] = v
        brackets = [sorted({b for (h, _), b in missed.items() if h == g}) for g in range(len(cols))]
        open_ranks = set(missed)
    for g, plan in plans.items():
        out[cols[g]] = (row[f"n{g}"], [(got[(g, i)], got[(g, j)], frac) for i, j, frac in plan])
    return out


def quantiles_many(df: DataFrame, cols: list[str], probs: list[float], row=None) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of several columns (`percentile` semantics)."""
    return {c: [None if x is None else x[0] if x[2] == 0 else _interpolate(*x) for x in got] for c, (_, got) in neighbours_many(df, cols, probs, row).items()}


def quantiles(df: DataFrame, c: str, probs: list[float]) -> list[float | None]:
    """Exact linear-interpolation quantiles of one column (pandas / `percentile` semantics)."""
    return quantiles_many(df, [c], probs)[c]


# ----------------------------------------------------------------- describe
QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Per column: count, mean, sample std, min, 25/50/75 % (exact), max. Without `cols`: all columns of a number type.

    The moments and the quantile sketch of all columns come from one
    aggregate, the exact quartiles from one more scan (`neighbours_many`).
    """
    cols = numeric_columns(df) if cols is None else cols
    moments = []
    for i, c in enumerate(cols):
        x = clean(df, c)
        moments += [F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}")]
    schema = "column_name string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    row = df.agg(*sketch_aggs(df, cols, QUARTILES), *moments).first()
    many = quantiles_many(df, cols, QUARTILES, row)
    rows = [(c, row[f"n{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"lo{i}"], *many[c], row[f"hi{i}"]) for i, c in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, schema)
    return out.select("column_name", "count", *[F.round(c, digits).alias(c) for c in out.columns[2:]])


def range_mean(df: DataFrame, c: str) -> DataFrame:
    x = clean(df, c)
    return df.agg(F.count(x).cast("long").alias("n"), F.min(x).alias("min_value"),
                  F.max(x).alias("max_value"), F.round(F.avg(x), 6).alias("mean_value"))


# ---------------------------------------------------------------- histogram
def finite(df: DataFrame, c: str) -> Column:
    """Column `c` as double with NaN and infinite values turned into NULL."""
    x = clean(df, c)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def finite_profile(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Per column: counts of finite, -Inf, +Inf, NaN and null values; mean, population std and bounds of the finite ones."""
    aggs = []
    for i, c in enumerate(cols):
        x, v, inf = finite(df, c), F.col(c).cast("double"), F.lit(float("inf"))
        aggs += [F.count(x).alias(f"n_finite{i}"), F.count_if(v == -inf).alias(f"n_neg_inf{i}"), F.count_if(v == inf).alias(f"n_pos_inf{i}"),
                 F.count_if(F.isnan(v)).alias(f"n_nan{i}"), F.count_if(v.isNull()).alias(f"n_null{i}"),
                 F.avg(x).alias(f"mean{i}"), F.stddev_pop(x).alias(f"std{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    rows = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}{i}").alias(n) for n in ("n_finite", "n_neg_inf", "n_pos_inf", "n_nan", "n_null")],
                     *[F.round(f"{n}{i}", digits).alias(n) for n in ("mean", "std", "min", "max")]) for i, c in enumerate(cols)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, c: str, bins: int = 50, tails: bool = False) -> DataFrame:
    """Equal-width bins over the finite values' [min, max], last bin closed; empty bins kept.

    (bin, bin_lo, bin_hi, count). Bounds are a one-row statistic; the counts
    are a `bins`-row aggregate joined to the `bins`-row bin list. Infinite
    values are in no bin; with `tails`, bin 0 counts -Inf and bin `bins` + 1
    counts +Inf. Without finite values there are no bins.
    """
    x = clean(df, c)
    inf = F.lit(float("inf"))
    st = df.agg(F.min(finite(df, c)).alias("lo"), F.max(finite(df, c)).alias("hi")).first()
    spark = df.sparkSession
    lo, hi = st["lo"], st["hi"]
    none = F.lit(None).cast("double")
    edges = spark.range(0).select(F.col("id").cast("int").alias("bin"), none.alias("bin_lo"), none.alias("bin_hi"))
    b = F.lit(1)
    if lo is not None:
        # Halves, as the difference of two finite values can be infinite.
        width = hi / 2 - lo / 2
        if width > 0:
            b = F.least(F.floor((x / 2 - F.lit(lo / 2)) / F.lit(width) * F.lit(bins)) + 1, F.lit(bins))
        step = F.lit(width) / F.lit(bins) * 2
        edges = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"), F.round(F.lit(lo) + (F.col("id") - 1) * step, 6).alias("bin_lo"),
                                                F.round(F.lit(lo) + F.col("id") * step, 6).alias("bin_hi"))
    b = F.when(x == -inf, 0).when(x == inf, bins + 1).otherwise(b).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).cast("long").alias("count"))
    if tails:
        edges = edges.unionByName(spark.createDataFrame([(0, float("-inf"), float("-inf")), (bins + 1, float("inf"), float("inf"))], "bin int, bin_lo double, bin_hi double"))
    return (edges.join(counts, "bin", "left")
                 .select("bin", "bin_lo", "bin_hi", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")).orderBy("bin"))


# ----------------------------------------------------------------- box plot
def boxplot_stats(df: DataFrame, c: str, whis: float = 1.5) -> DataFrame:
    """Q1, median, Q3, IQR, whiskers (furthest points inside 1.5 IQR), outlier count."""
    q1, med, q3 = quantiles(df, c, [0.25, 0.5, 0.75])
    x = clean(df, c)
    if q1 is None:
        lo_f = hi_f = None
    else:
        iqr = q3 - q1
        lo_f, hi_f = q1 - whis * iqr, q3 + whis * iqr
    lo_l, hi_l = F.lit(lo_f).cast("double"), F.lit(hi_f).cast("double")
    return df.agg(
        F.count(x).cast("long").alias("n"),
        F.round(F.lit(q1).cast("double"), 6).alias("q1"),
        F.round(F.lit(med).cast("double"), 6).alias("median"),
        F.round(F.lit(q3).cast("double"), 6).alias("q3"),
        F.round(F.lit(q3).cast("double") - F.lit(q1).cast("double"), 6).alias("iqr"),
        F.round(F.min(F.when(x >= lo_l, x)), 6).alias("lower_whisker"),
        F.round(F.max(F.when(x <= hi_l, x)), 6).alias("upper_whisker"),
        F.count_if((x < lo_l) | (x > hi_l)).cast("long").alias("n_outliers"),
    )
