"""Quantiles, histogram and box-plot edge cases."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from vigil.operators import profile as PR
from vigil.sources.views import table


def builtin(df, c, probs):
    return list(df.agg(F.percentile(c, F.array(*[F.lit(p) for p in probs]))).first()[0])


def test_selection_matches_builtin(spark):
    li = table(spark, SF, "lineitem")
    probs = [0.0, 0.02, 0.25, 0.5, 0.75, 0.999, 1.0]
    exact = builtin(li, "l_extendedprice", probs)
    selected = PR.quantiles(li, "l_extendedprice", probs)
    assert [round(x, 9) for x in exact] == [round(x, 9) for x in selected]


def ranked(df, c):
    return sorted(r[c] for r in df.collect() if r[c] is not None)


def check_neighbours(df, c, probs):
    vals = ranked(df, c)
    n, got = PR.neighbours_many(df, [c], probs)[c]
    assert n == len(vals)
    for p, (lo, hi, frac) in zip(probs, got):
        pos = p * (n - 1)
        assert (lo, hi, frac) == (vals[int(pos)], vals[min(int(pos) + 1, n - 1)], pos - int(pos))


def test_selection_with_hot_value(spark, monkeypatch):
    # A third of the rows share one value; other values spread around it.
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(42.0)).otherwise(F.col("id").cast("double")).alias("x"))
    monkeypatch.setattr(PR, "PART_VALUES", 5)
    probs = [0.1, 0.33, 0.5, 0.9]
    assert PR.quantiles(df, "x", probs) == builtin(df, "x", probs)
    check_neighbours(df, "x", [0.0, 0.1667, 1 / 3, 0.5, 1.0])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 10, 101])
def test_selection_of_few_values(spark, n):
    df = spark.range(0, n).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    check_neighbours(df, "x", [i / 20 for i in range(21)])


def test_one_row_histogram_and_box(spark):
    df = spark.createDataFrame([(7.5,)], "x double")
    h = PR.histogram(df, "x", 5).collect()
    assert len(h) == 5 and h[0]["count"] == 1 and sum(r["count"] for r in h) == 1
    b = PR.boxplot_stats(df, "x").first()
    assert b["q1"] == b["median"] == b["q3"] == 7.5 and b["n_outliers"] == 0


def test_nan_skipped(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    d = PR.describe(df, ["x"]).first()
    assert d["count"] == 2 and d["mean"] == 2.0 and d["max"] == 3.0
    assert PR.quantiles(df, "x", [0.5]) == [2.0]


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    h = {r["bin"]: r["count"] for r in PR.histogram(df, "x", 2).collect()}
    assert h == {1: 1, 2: 2}


def test_empty_quantiles(spark):
    df = spark.createDataFrame([], "x double")
    assert PR.quantiles(df, "x", [0.5]) == [None]


def test_wide_brackets_are_ranked_in_parts(spark, monkeypatch):
    # A coarse sketch leaves much to count; tiny parts split what lies in a bracket.
    df = spark.range(0, 5000).select(
        (F.abs(F.hash("id")) % 997 + F.when(F.col("id") % 7 == 0, F.lit(0.5)).otherwise(0.0)).cast("double").alias("x"))
    monkeypatch.setattr(PR, "ACCURACY", 20)
    monkeypatch.setattr(PR, "MARGIN", 3 / 20)
    monkeypatch.setattr(PR, "PART_VALUES", 20)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    check_neighbours(df, "x", probs)
    assert PR.quantiles(df, "x", probs) == builtin(df, "x", probs)


def test_two_scans_whatever_the_data(spark, monkeypatch):
    import math
    calls, cells = [], PR._cells
    monkeypatch.setattr(PR, "_cells", lambda *a: calls.append(1) or cells(*a))
    x = F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 11 == 0, math.inf).when(F.col("id") % 13 == 0, -math.inf).otherwise(F.hash("id") / 3e4)
    df = spark.range(0, 50000).select(x.alias("a"), F.lit(1.5).alias("b"), (F.col("id") % 2).alias("c"), F.lit(None).cast("double").alias("d"), F.lit("t").alias("e"))
    rows = {r["column_name"]: r for r in PR.describe(df).collect()}
    assert len(calls) == 1 and list(rows) == ["a", "b", "c", "d"]
    assert rows["d"]["count"] == 0 and rows["d"]["p50"] is None and rows["b"]["p25"] == rows["b"]["p75"] == 1.5
    want = builtin(df, "a", [0.25, 0.5, 0.75])
    assert [rows["a"][k] for k in ("p25", "p50", "p75")] == [round(v, 6) for v in want] and rows["a"]["max"] == math.inf


def test_a_sketch_that_misses_is_made_good(spark, monkeypatch):
    # Brackets that hold none of the ranks: the gap in which a rank lies is the next bracket.
    monkeypatch.setattr(PR, "_brackets", lambda row, i, probs: [(3000.25, 3000.75)])
    check_neighbours(spark.range(0, 10000).select(F.col("id").cast("double").alias("x")), "x", [0.1, 0.5, 0.9])


def test_describe_selection_path_matches(spark, monkeypatch):
    li = table(spark, SF, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    exact = PR.describe(li, cols).orderBy("column_name").collect()
    for r in exact:
        assert [r["p25"], r["p50"], r["p75"]] == [round(x, 6) for x in builtin(li, r["column_name"], [0.25, 0.5, 0.75])]
    monkeypatch.setattr(PR, "PART_VALUES", 50)
    selected = PR.describe(li, cols).orderBy("column_name").collect()
    assert exact == selected


def test_infinite_values(spark):
    import math
    rows = [(float(i),) for i in range(500)] + [(math.inf,), (math.inf,), (-math.inf,), (math.nan,), (None,)]
    df = spark.createDataFrame(rows, "v double")
    check_neighbours(df.where("NOT isnan(v)"), "v", [k / 502 for k in (0, 1, 250, 500, 501, 502)])
    h = {r["bin"]: r["count"] for r in PR.histogram(df, "v", 4, tails=True).collect()}
    assert h == {0: 1, 1: 125, 2: 125, 3: 125, 4: 125, 5: 2}
    assert [r["count"] for r in PR.histogram(df, "v", 4).collect()] == [125] * 4
    f = PR.finite_profile(df, ["v"]).first()
    assert (f["n_finite"], f["n_neg_inf"], f["n_pos_inf"], f["n_nan"], f["n_null"], f["mean"], f["max"]) == (500, 1, 2, 1, 1, 249.5, 499.0)
    from vigil.operators.scaling import standardize
    z = [r["v"] for r in standardize(df.where("v >= 498 OR v < 0"), ["v"]).collect()]
    assert sorted(x for x in z if x is not None) == [-math.inf, -1.0, 1.0, math.inf, math.inf]


def test_histogram_of_no_finite_value(spark):
    df = spark.createDataFrame([(float("inf"),), (None,)], "v double")
    assert PR.histogram(df, "v", 3).count() == 0
    assert [(r["bin"], r["count"]) for r in PR.histogram(df, "v", 3, tails=True).collect()] == [(0, 0), (4, 1)]


def test_histogram_of_the_widest_range(spark):
    df = spark.createDataFrame([(-1.7e308,), (0.0,), (1.7e308,)], "v double")
    assert [r["count"] for r in PR.histogram(df, "v", 2).collect()] == [1, 2]
