"""Edge rows for the five rules (null / NaN / boundary semantics)."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.buckets import bucketize
from vigil.operators import quality as Q
from vigil.operators import rules as R

INF = float("inf")
NAN = float("nan")

# (amount, time, class, expected failing rules, expected bucket)
EDGE = [
    (0.0, 0.0, 0.0, set(), "$0-10"),
    (-0.01, 5.0, 1.0, {"non_negative_amount"}, "$0-10"),
    (20000.00, 1.0, 0.0, set(), "$5K+"),
    (20000.01, 1.0, 0.0, {"reasonable_amount"}, "$5K+"),
    (None, 1.0, 0.0, {"non_negative_amount", "reasonable_amount", "no_null_values"}, "$5K+"),
    (NAN, 1.0, 0.0, {"non_negative_amount", "reasonable_amount", "no_null_values"}, "$5K+"),
    (10.0, -1.0, 0.0, {"non_negative_time"}, "$10-50"),
    (10.0, 1.0, None, {"valid_class_label", "no_null_values"}, "$10-50"),
    (10.0, 1.0, 2.0, {"valid_class_label"}, "$10-50"),
    (10.0, 1.0, 0.5, {"valid_class_label"}, "$10-50"),
    (INF, 1.0, 0.0, {"reasonable_amount"}, "$5K+"),
]

SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("time_elapsed", T.DoubleType()),
    T.StructField("class", T.DoubleType()),
])


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i + 1, a, t, c) for i, (a, t, c, _, _) in enumerate(EDGE)]
    return spark.createDataFrame(rows, SCHEMA)


def test_edge_rows_long_form(edge):
    got = {}
    for r in R.evaluate(edge).collect():
        assert r["rule_passed"] is not None
        if not r["rule_passed"]:
            got.setdefault(r["transaction_id"], set()).add(r["rule_name"])
    for i, (_, _, _, fails, _) in enumerate(EDGE):
        assert got.get(i + 1, set()) == fails, (i + 1, got.get(i + 1))


def test_buckets(edge):
    got = {r["transaction_id"]: r["b"] for r in edge.select("transaction_id", bucketize("amount").alias("b")).collect()}
    for i, (*_, bucket) in enumerate(EDGE):
        assert got[i + 1] == bucket, i + 1


def test_identities(edge):
    s = Q.summary_fused(edge).collect()
    assert [r["rule_name"] for r in s] == sorted(R.rule_names())
    n = edge.count()
    assert all(r["passed"] + r["failed"] == n for r in s)
    t = Q.check_totals(Q.summary_fused(edge)).first()
    assert t["total_checks"] == 5 * n
    assert t["passed_checks"] + t["failed_checks"] == t["total_checks"]
    long_s = {r["rule_name"]: (r["passed"], r["failed"]) for r in Q.summary_long(R.evaluate(edge)).collect()}
    assert long_s == {r["rule_name"]: (r["passed"], r["failed"]) for r in s}


def test_score_and_empty_history(spark, edge):
    h = Q.history_row(edge, record_date="2024-01-02").first()
    fails = sum(len(f) for *_, f, _ in EDGE)
    assert h["failed_checks"] == fails
    assert h["quality_score"] == round(100 * (1 - fails / (5 * len(EDGE))), 2)
    empty = spark.createDataFrame([], SCHEMA)
    assert Q.history_row(empty, record_date="2024-01-02").count() == 0
    assert Q.quality_score(Q.check_totals(Q.summary_fused(empty))).first()["quality_score"] is None


def test_class_checked_before_cast(spark):
    # 0.5 must fail even though narrowing to a byte would turn it into 0.
    df = spark.createDataFrame([(1, 1.0, 1.0, 0.5)], SCHEMA)
    row = R.evaluate_wide(df).first()
    assert row["valid_class_label"] is False


def test_unique_key_rule(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    got = sorted((r["k"] if r["k"] is not None else -1, r["unique_id"]) for r in R.unique_key_rule(df, "k").collect())
    assert got == [(-1, False), (1, True), (2, False), (2, False)]


def test_unique_key_of_two_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1), (1, None), (1, None)], "a long, b long")
    got = sorted((r["a"], r["b"] or -1, r["unique_id"]) for r in R.unique_key_rule(df, ["a", "b"]).collect())
    assert got == [(1, -1, False), (1, -1, False), (1, 1, True), (1, 2, True), (2, 1, False), (2, 1, False)]


def test_long_form_has_no_exchange(spark):
    from vigil.sources.views import view
    from conftest import SF
    plan = R.evaluate(view(spark, SF, "tx_acct"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan


def test_sample_rules(spark):
    df = spark.createDataFrame([(1, "2024-02-30", None, 0.0), (2, "", 5, 3.0), (3, "2024-03-01", 7, -1.0)],
                               "transaction_id long, transaction_date string, customer_id long, amount double")
    rules = [R.positive("positive_amount", "amount"), R.not_blank("customer_present", "customer_id"), R.parseable_date("parseable_date", "transaction_date")]
    w = {r["transaction_id"]: r for r in R.evaluate_wide(df, rules).collect()}
    assert [w[i]["parseable_date"] for i in (1, 2, 3)] == [False, False, True]
    assert [w[i]["customer_present"] for i in (1, 2, 3)] == [False, True, True]
    assert [w[i]["positive_amount"] for i in (1, 2, 3)] == [False, True, False]
    assert not math.isnan(0.0)
