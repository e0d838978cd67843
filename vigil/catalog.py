"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB oracle statement per operator of the inventory.

Each callable takes (spark, sf_dir) and returns a DataFrame. Oracle SQL runs
against views named after the driver's tables; the transaction views are
prefixed as CTEs (see `vigil.sources.views.VIEW_SQL`). Column names match
between the two sides; derived doubles are rounded on both sides so the
order of summation cannot change a compared value.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import quality as Q
from vigil.operators import rules as R
from vigil.sources.views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, raw: bool = False):
    """Register a Spark query and its oracle; `raw` SQL already defines its CTEs."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql if raw else with_views(sql)
        return fn
    return deco


# --------------------------------------------------------------------------
# SQL spelling of the default rules per view (column types differ per view).
# --------------------------------------------------------------------------
VIEW_COLUMNS = {
    "tx_events": {"time_elapsed": "d", "amount": "d", "class": "i", "v1": "d", "v2": "d", "v3": "d", "region": "s"},
    "tx_orders": {"time_elapsed": "d", "amount": "d", "class": "i", "v1": "d", "v2": "d", "customer_id": "i", "region": "s"},
    "tx_acct": {"time_elapsed": "d", "amount": "d", "class": "i", "v1": "d", "region": "s"},
    "tx_docs": {"time_elapsed": "d", "amount": "d", "class": "i", "v1": "d", "region": "s"},
    "tx_card": {"time_elapsed": "d", "v1": "d", "v2": "d", "v3": "d", "amount": "d", "class": "i"},
}


def _present_sql(c: str, kind: str) -> str:
    return f"({c} IS NOT NULL AND NOT isnan({c}))" if kind == "d" else f"({c} IS NOT NULL)"


def rule_sql(view_name: str) -> dict[str, str]:
    cols = VIEW_COLUMNS[view_name]
    nn = " AND ".join(_present_sql(c, k) for c, k in cols.items())
    return {
        "non_negative_amount": "coalesce(amount >= 0 AND NOT isnan(amount), false)",
        "non_negative_time": "coalesce(time_elapsed >= 0 AND NOT isnan(time_elapsed), false)",
        "no_null_values": f"coalesce({nn}, false)",
        "valid_class_label": "coalesce(class IN (0, 1), false)",
        "reasonable_amount": "coalesce(amount <= 20000 AND NOT isnan(amount), false)",
    }


def long_sql(view_name: str, carry: str = "") -> str:
    """Long-form check results of a view as a SQL subquery."""
    parts = [
        f"SELECT transaction_id, '{n}' AS rule_name, {e} AS rule_passed{carry} FROM {view_name}"
        for n, e in rule_sql(view_name).items()
    ]
    return "(" + " UNION ALL ".join(parts) + ")"


def summary_sql(view_name: str) -> str:
    return f"""SELECT rule_name,
                      CAST(count_if(rule_passed) AS BIGINT) AS passed,
                      CAST(count_if(NOT rule_passed) AS BIGINT) AS failed
               FROM {long_sql(view_name)} GROUP BY rule_name"""


# --------------------------------------------------------------------------
# R: rules
# --------------------------------------------------------------------------
def _single_rule(view_name: str, rule_name: str):
    rule = next(r for r in R.DEFAULT_RULES if r.name == rule_name)

    def q(spark, sf_dir):
        df = view(spark, sf_dir, view_name)
        return df.select("transaction_id", rule.column(df).alias("rule_passed"))

    sql = f"SELECT transaction_id, {rule_sql(view_name)[rule_name]} AS rule_passed FROM {view_name}"
    return q, sql


for _qname, _view, _rule in [
    ("r1_non_negative_amount", "tx_acct", "non_negative_amount"),
    ("r2_non_negative_time", "tx_orders", "non_negative_time"),
    ("r3_no_null_values", "tx_docs", "no_null_values"),
    ("r4_valid_class_label", "tx_docs", "valid_class_label"),
    ("r5_reasonable_amount", "tx_orders", "reasonable_amount"),
]:
    _fn, _sql = _single_rule(_view, _rule)
    register(_qname, _sql)(_fn)


@register("r6_evaluate_long", f"SELECT transaction_id, rule_name, rule_passed FROM {long_sql('tx_docs')}")
def r6_evaluate_long(spark, sf_dir):
    return R.evaluate(view(spark, sf_dir, "tx_docs"))


# --------------------------------------------------------------------------
# failures
# --------------------------------------------------------------------------
@register("p1_failed_checks",
          f"SELECT transaction_id, rule_name FROM {long_sql('tx_orders')} WHERE NOT rule_passed")
def p1_failed_checks(spark, sf_dir):
    return R.failures(R.evaluate(view(spark, sf_dir, "tx_orders"))).select("transaction_id", "rule_name")


@register("j1_failures_with_amount",
          f"SELECT transaction_id, rule_name, amount FROM {long_sql('tx_orders', ', amount')} WHERE rule_passed IS FALSE")
def j1_failures_with_amount(spark, sf_dir):
    # The amount is carried through evaluation: no join back to the table.
    return R.failures(R.evaluate(view(spark, sf_dir, "tx_orders"), carry=["amount"])).select(
        "transaction_id", "rule_name", "amount")


@register("w2_failures_first_500", f"""
    SELECT transaction_id, rule_name, amount
    FROM {long_sql('tx_orders', ', amount')} WHERE NOT rule_passed
    ORDER BY transaction_id, rule_name LIMIT 500""")
def w2_failures_first_500(spark, sf_dir):
    fails = R.failures(R.evaluate(view(spark, sf_dir, "tx_orders"), carry=["amount"]))
    return fails.orderBy("transaction_id", "rule_name").limit(500).select("transaction_id", "rule_name", "amount")


# --------------------------------------------------------------------------
# Summaries and score
# --------------------------------------------------------------------------
@register("a1_validation_summary", summary_sql("tx_acct") + " ORDER BY rule_name")
def a1_validation_summary(spark, sf_dir):
    return Q.summary_fused(view(spark, sf_dir, "tx_acct"))


@register("a1_validation_summary_long", summary_sql("tx_orders") + " ORDER BY rule_name")
def a1_validation_summary_long(spark, sf_dir):
    return Q.summary_long(R.evaluate(view(spark, sf_dir, "tx_orders")))


@register("a2_failures_by_rule",
          f"SELECT rule_name, failed FROM ({summary_sql('tx_orders')}) WHERE failed > 0 ORDER BY rule_name")
def a2_failures_by_rule(spark, sf_dir):
    return Q.failures_by_rule(Q.summary_fused(view(spark, sf_dir, "tx_orders")))


_TOTALS_SQL = """SELECT CAST(count(*) AS BIGINT) AS total_checks,
                        CAST(count_if(rule_passed) AS BIGINT) AS passed_checks,
                        CAST(count_if(NOT rule_passed) AS BIGINT) AS failed_checks
                 FROM {src}"""


@register("a3_check_totals", _TOTALS_SQL.format(src=long_sql("tx_docs")))
def a3_check_totals(spark, sf_dir):
    return Q.check_totals(Q.summary_fused(view(spark, sf_dir, "tx_docs")))


@register("a4_quality_score", f"""
    SELECT *, round(100 * (1 - failed_checks::DOUBLE / nullif(total_checks, 0)), 2) AS quality_score
    FROM ({_TOTALS_SQL.format(src=long_sql('tx_orders'))})""")
def a4_quality_score(spark, sf_dir):
    return Q.quality_score(Q.check_totals(Q.summary_fused(view(spark, sf_dir, "tx_orders"))))


HISTORY_DATE = "2024-06-30"


@register("a5_history_row", f"""
    SELECT DATE '{HISTORY_DATE}' AS record_date,
           round(100 * (1 - failed_checks::DOUBLE / total_checks), 2) AS quality_score,
           total_rows, failed_checks
    FROM (SELECT CAST(count(DISTINCT transaction_id) AS BIGINT) AS total_rows,
                 CAST(count_if(NOT rule_passed) AS BIGINT) AS failed_checks,
                 count(*) AS total_checks
          FROM {long_sql('tx_docs')})
    WHERE total_checks > 0""")
def a5_history_row(spark, sf_dir):
    return Q.history_row(view(spark, sf_dir, "tx_docs"), record_date=HISTORY_DATE)


@register("a6_row_count", "SELECT CAST(count(*) AS BIGINT) AS total_rows FROM tx_orders")
def a6_row_count(spark, sf_dir):
    return Q.row_count(view(spark, sf_dir, "tx_orders"))


@register("a17_pass_rates", f"""
    SELECT rule_name, passed, failed,
           round(100 * passed::DOUBLE / nullif(passed + failed, 0), 2) AS pass_rate
    FROM ({summary_sql('tx_docs')}) ORDER BY rule_name""")
def a17_pass_rates(spark, sf_dir):
    return Q.pass_rates(Q.summary_fused(view(spark, sf_dir, "tx_docs")))


# --------------------------------------------------------------------------
# profiles
# --------------------------------------------------------------------------
from vigil.operators import profile as PR  # noqa: E402
from vigil.sources.views import table  # noqa: E402

LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a10_category_counts", """
    SELECT region, CAST(count(*) AS BIGINT) AS n FROM tx_orders
    WHERE region IS NOT NULL GROUP BY region ORDER BY n DESC, region""")
def a10_category_counts(spark, sf_dir):
    return PR.category_counts(view(spark, sf_dir, "tx_orders"), "region")


def _describe_sql(tbl: str, cols: list[str]) -> str:
    parts = [f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count,
                        round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
                        round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
                        round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,
                        round(max({c}), 6) AS max FROM {tbl}""" for c in cols]
    return " UNION ALL ".join(parts)


@register("a12_describe", _describe_sql("lineitem", LINEITEM_NUMERIC))
def a12_describe(spark, sf_dir):
    return PR.describe(table(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC)


@register("a13_range_mean", """
    SELECT CAST(count(amount) AS BIGINT) AS n, min(amount) AS min_value, max(amount) AS max_value,
           round(avg(amount), 6) AS mean_value
    FROM tx_acct WHERE amount > 0 AND NOT isnan(amount)""")
def a13_range_mean(spark, sf_dir):
    df = view(spark, sf_dir, "tx_acct")
    return PR.range_mean(df.where((F.col("amount") > 0) & ~F.isnan("amount")), "amount")


@register("a14_histogram", """
    WITH b AS (SELECT min(amount) AS lo, max(amount) AS hi FROM tx_events),
         c AS (SELECT CAST(least(floor((amount - lo) / (hi - lo) * 50) + 1, 50) AS INTEGER) AS bin,
                      count(*) AS cnt
               FROM tx_events, b WHERE amount IS NOT NULL GROUP BY 1),
         e AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 51))
    SELECT e.bin, round(lo + (e.bin - 1) * ((hi - lo) / 50), 6) AS bin_lo,
           round(lo + e.bin * ((hi - lo) / 50), 6) AS bin_hi,
           CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
    FROM e CROSS JOIN b LEFT JOIN c ON e.bin = c.bin ORDER BY e.bin""")
def a14_histogram(spark, sf_dir):
    return PR.histogram(view(spark, sf_dir, "tx_events"), "amount", 50)


@register("a15_boxplot", """
    WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS med,
                      quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
         f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
    SELECT CAST(count(l_extendedprice) AS BIGINT) AS n, round(any_value(q1), 6) AS q1,
           round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
           round(any_value(q3) - any_value(q1), 6) AS iqr,
           round(min(CASE WHEN l_extendedprice >= lo_f THEN l_extendedprice END), 6) AS lower_whisker,
           round(max(CASE WHEN l_extendedprice <= hi_f THEN l_extendedprice END), 6) AS upper_whisker,
           CAST(count_if(l_extendedprice < lo_f OR l_extendedprice > hi_f) AS BIGINT) AS n_outliers
    FROM lineitem, f""")
def a15_boxplot(spark, sf_dir):
    return PR.boxplot_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@register("p3_valid_amounts", """
    SELECT transaction_id, amount FROM tx_acct
    WHERE amount IS NOT NULL AND NOT isnan(amount) AND amount > 0""")
def p3_valid_amounts(spark, sf_dir):
    df = view(spark, sf_dir, "tx_acct")
    return df.where(R.positive("valid", "amount").column(df)).select("transaction_id", "amount")


@register("p4_drop_missing", "SELECT transaction_id, class FROM tx_docs WHERE class IS NOT NULL")
def p4_drop_missing(spark, sf_dir):
    from vigil.functions.nulls import drop_missing
    return drop_missing(view(spark, sf_dir, "tx_docs"), ["class"]).select("transaction_id", "class")


# --------------------------------------------------------------------------
# The checks that a dirty sample calls for, on the given tables
# --------------------------------------------------------------------------
from vigil import schemas as SCH  # noqa: E402
from vigil.session import scratch_dir  # noqa: E402
from vigil.sources import csv as CSV  # noqa: E402


@register("d1_unique_id", """
    SELECT l_orderkey, l_linenumber, l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
           AND count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 AS unique_id FROM lineitem""")
def d1_unique_id(spark, sf_dir):
    key = ["l_orderkey", "l_linenumber"]
    return R.unique_key_rule(table(spark, sf_dir, "lineitem").select(*key), key)


@register("d2_label_present",
          "SELECT transaction_id, class IS NOT NULL AND trim(CAST(class AS VARCHAR)) <> '' AS rule_passed FROM tx_docs")
def d2_label_present(spark, sf_dir):
    df = view(spark, sf_dir, "tx_docs")
    return df.select("transaction_id", R.not_blank("label_present", "class").column(df).alias("rule_passed"))


@register("d3_parseable_date", """
    SELECT o_orderkey, coalesce(try_strptime(CAST(o_orderdate AS DATE)::VARCHAR, '%Y-%m-%d') IS NOT NULL, false)
           AS rule_passed FROM orders""")
def d3_parseable_date(spark, sf_dir):
    path = scratch_dir(spark, "order_dates_csv")
    CSV.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), path)
    back = CSV.read_csv(spark, path, SCH.ORDER_DATES)
    return back.select("o_orderkey", R.parseable_date("parseable_date", "day").column(back).alias("rule_passed"))


@register("d4_positive_amount", """
    SELECT c_custkey, c_acctbal, coalesce(c_acctbal > 0 AND NOT isnan(c_acctbal), false) AS rule_passed FROM customer""")
def d4_positive_amount(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return df.withColumn("rule_passed", R.positive("positive_amount", "c_acctbal").column(df))


# --------------------------------------------------------------------------
# Scaling and the isolation forest
# --------------------------------------------------------------------------
from vigil.forest_sql import cut_ctes, forest_ctes, with_ctes  # noqa: E402
from vigil.operators import detect as DT  # noqa: E402
from vigil.operators import iforest as IF  # noqa: E402
from vigil.operators import reports as RP  # noqa: E402
from vigil.operators import scaling as SC  # noqa: E402
from vigil.sources.views import FEATURES, VIEW_SQL  # noqa: E402

PARAMS = IF.ForestParams()
VALID_AMOUNT = "amount IS NOT NULL AND NOT isnan(amount) AND amount > 0"


def _valid_amount(df):
    return df.where(R.positive("valid", "amount").column(df))


def det_ctes(view_name: str, features: list[str], scale: bool = True, where: str | None = None,
             params: IF.ForestParams = PARAMS) -> list[tuple[str, str]]:
    """SQL twin of `detect` on a view: f_rows, forest CTEs, f_cut, `an` (stored rows), `scored`."""
    complete = " AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in features)
    ctes = [(view_name, VIEW_SQL[view_name]),
            ("f_rows", f"SELECT * FROM {view_name}" + (f" WHERE {where}" if where else "")),
            ("f_base", f"SELECT * FROM f_rows WHERE {complete}")]
    if scale:
        z = SC.sql_standardize("f_base", features, keep=["transaction_id"])
        ctes.append(("f_src", f"SELECT transaction_id AS _id, {', '.join(features)} FROM ({z})"))
    else:
        ctes.append(("f_src", f"SELECT transaction_id AS _id, {', '.join(features)} FROM f_base"))
    ctes += forest_ctes("f_src", features, params) + cut_ctes(params.contamination)
    ctes.append(("an", """SELECT s._id * 16 AS id, s._id AS transaction_id, round(s.raw_score - c.cut_raw, 6) AS anomaly_score,
                          'IsolationForest' AS detection_method
                   FROM f_scores s, f_cut c WHERE s.path_units < c.t_units"""))
    ctes.append(("scored", """SELECT r.*, s.path_units, s.raw_score, s.raw_score - c.cut_raw AS decision,
                              coalesce(s.path_units < c.t_units, false) AS flagged
                       FROM f_rows r LEFT JOIN f_scores s ON r.transaction_id = s._id CROSS JOIN f_cut c"""))
    return ctes


def _detect(spark, sf_dir, view_name, features=None, scale=True, valid_amount=False, params=PARAMS, carry=()):
    """The detector on a view; `carry` names the columns beside id and features that the report needs (None: all)."""
    df = view(spark, sf_dir, view_name)
    if valid_amount:
        df = _valid_amount(df)
    return DT.detect(df, features or FEATURES[view_name], params=params, scale=scale, carry=None if carry is None else list(carry),
                     stage_partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


def det_register(name: str, view_name: str, body: str, features=None, scale=True, where=None):
    sql = with_ctes(det_ctes(view_name, features or FEATURES[view_name], scale, where), body)
    return register(name, sql, raw=True)


_EV = FEATURES["tx_events"]


@register("m1_standardize", with_views(
    f"SELECT transaction_id, {', '.join(f'round({c}, 6) AS {c}' for c in _EV)} FROM ("
    + SC.sql_standardize("tx_events", _EV, ["transaction_id"]) + ")"), raw=True)
def m1_standardize(spark, sf_dir):
    df = view(spark, sf_dir, "tx_events").select("transaction_id", *_EV)
    return SC.standardize(df, _EV).select("transaction_id", *[F.round(c, 6).alias(c) for c in _EV])


@det_register("m2_forest_nodes", "tx_events",
              "SELECT tree, node, depth, size, is_leaf, feature, round(split, 6) AS split, units FROM f_nodes")
def m2_forest_nodes(spark, sf_dir):
    forest = IF.fit(IF.survey(view(spark, sf_dir, "tx_events"), "transaction_id", _EV, PARAMS), PARAMS, scale=True)
    return forest.nodes.withColumn("split", F.round("split", 6))


@det_register("m3_scores", "tx_events",
              "SELECT transaction_id, path_units, round(raw_score, 6) AS raw_score FROM scored")
def m3_scores(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events")
    return d.scored.select("transaction_id", "path_units", F.round("raw_score", 6).alias("raw_score"))


@det_register("m4_contamination_cut", "tx_events", """
    SELECT transaction_id, path_units,
           CASE WHEN path_units IS NULL THEN NULL WHEN flagged THEN -1 ELSE 1 END AS prediction FROM scored""")
def m4_contamination_cut(spark, sf_dir):
    return RP.predictions(_detect(spark, sf_dir, "tx_events").scored)


@det_register("m5_score_rounding", "tx_events",
              "SELECT transaction_id, round(decision, 6) AS anomaly_score FROM scored WHERE flagged")
def m5_score_rounding(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events")
    return DT.anomalies(d).select("transaction_id", "anomaly_score")


@det_register("m6_detector", "tx_events", "SELECT id, transaction_id, anomaly_score, detection_method FROM an")
def m6_detector(spark, sf_dir):
    return DT.anomalies(_detect(spark, sf_dir, "tx_events"))


@det_register("m7_one_feature", "tx_events", "SELECT transaction_id, anomaly_score FROM an",
              features=["amount"], scale=False, where=VALID_AMOUNT)
def m7_one_feature(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events", ["amount"], scale=False, valid_amount=True)
    return DT.anomalies(d).select("transaction_id", "anomaly_score")


@det_register("a16_detection_metrics", "tx_events", """
    SELECT total_rows, anomalies, total_frauds, frauds_caught, total_rows - anomalies AS normal,
           round(100 * rec, 1) AS recall_pct, round(100 * prec, 1) AS precision_pct,
           round(CASE WHEN rec + prec > 0 THEN 200 * rec * prec / (rec + prec) ELSE 0.0 END, 1) AS f1_pct
    FROM (SELECT *, frauds_caught / greatest(total_frauds, 1) AS rec, frauds_caught / greatest(anomalies, 1) AS prec
          FROM (SELECT CAST(count_if(flagged) AS BIGINT) AS anomalies,
                       CAST(count_if(coalesce(class = 1, false)) AS BIGINT) AS total_frauds,
                       CAST(count_if(flagged AND coalesce(class = 1, false)) AS BIGINT) AS frauds_caught,
                       CAST(count(*) AS BIGINT) AS total_rows FROM scored))""")
def a16_detection_metrics(spark, sf_dir):
    return DT.metrics(_detect(spark, sf_dir, "tx_events", carry=["class"]))


def _sweep_sql(rates=(0.01, 0.02, 0.05, 0.10)) -> str:
    ctes = det_ctes("tx_events", ["amount"], False, VALID_AMOUNT)
    parts = []
    for i, r in enumerate(rates):
        ctes += cut_ctes(r, name=f"c{i}")
        parts.append(f"""SELECT CAST({r!r} AS DOUBLE) AS contamination,
                                CAST((SELECT count(*) FROM f_scores WHERE path_units < (SELECT t_units FROM c{i})) AS BIGINT) AS anomalies_found""")
    body = f"""SELECT contamination, anomalies_found,
                      printf('%.1f%%', round(100.0 * anomalies_found / (SELECT count(*) FROM f_scores), 1)) AS anomaly_pct
               FROM ({' UNION ALL '.join(parts)})"""
    return with_ctes(ctes, body)


@register("a18_contamination_sweep", _sweep_sql(), raw=True)
def a18_contamination_sweep(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events", ["amount"], scale=False, valid_amount=True)
    return DT.sweep(d)


@det_register("a19_flagged_share", "tx_events", """
    SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if(flagged) AS BIGINT) AS anomalies,
           CAST(count_if(NOT flagged) AS BIGINT) AS normal,
           round(100.0 * count_if(flagged) / greatest(count(*), 1), 1) AS anomaly_pct
    FROM scored WHERE path_units IS NOT NULL""", features=["amount"], scale=False, where=VALID_AMOUNT)
def a19_flagged_share(spark, sf_dir):
    return DT.flagged_share(_detect(spark, sf_dir, "tx_events", ["amount"], scale=False, valid_amount=True))


# --------------------------------------------------------------------------
# Reports on the detector output
# --------------------------------------------------------------------------
from vigil.functions.buckets import AMOUNT_CUTS, AMOUNT_LABELS, sql_bucketize  # noqa: E402


@det_register("a8_fraud_breakdown", "tx_events", """
    SELECT is_fraud, status, cnt
    FROM (SELECT class AS is_fraud, count(*) FILTER (flagged) AS "Flagged", count(*) FILTER (NOT flagged) AS "Not Flagged"
          FROM scored GROUP BY ALL)
    UNPIVOT (cnt FOR status IN ("Flagged", "Not Flagged")) WHERE cnt > 0""")
def a8_fraud_breakdown(spark, sf_dir):
    return RP.fraud_breakdown_scored(_detect(spark, sf_dir, "tx_events", carry=["class"]).scored)


def _distribution_sql(src: str = "scored", weight: str = "1", hits: str = "flagged::INT") -> str:
    """Rows and flagged rows per amount range: a range is found by the number of cuts that its amounts reach."""
    return f"""
    SELECT {AMOUNT_LABELS}[1 + len(list_filter({AMOUNT_CUTS}, lambda cut: coalesce(amount, 'infinity') >= cut))] AS amount_range,
           sum({weight})::BIGINT AS total, sum({hits})::BIGINT AS anomalies
    FROM {src} GROUP BY ALL"""


@det_register("a9_amount_distribution", "tx_acct", _distribution_sql())
def a9_amount_distribution(spark, sf_dir):
    return RP.amount_distribution_scored(_detect(spark, sf_dir, "tx_acct", carry=["amount"]).scored)


@det_register("w6_order_by_aggregate", "tx_events", _distribution_sql())
def w6_order_by_aggregate(spark, sf_dir):
    return RP.amount_distribution_scored(_detect(spark, sf_dir, "tx_events", carry=["amount"]).scored)


@det_register("a11_anomalies_by_region", "tx_orders", """
    SELECT region, CAST(count(*) AS BIGINT) AS count FROM scored
    WHERE flagged AND region IS NOT NULL GROUP BY region ORDER BY region""")
def a11_anomalies_by_region(spark, sf_dir):
    return RP.anomalies_by_region(_detect(spark, sf_dir, "tx_orders", carry=["region"]).scored)


@det_register("j2_top_anomalies", "tx_events", """
    SELECT transaction_id, round(decision, 6) AS anomaly_score, 'IsolationForest' AS detection_method, amount, class AS is_fraud
    FROM scored WHERE flagged QUALIFY row_number() OVER (ORDER BY anomaly_score, transaction_id) <= 200""")
def j2_top_anomalies(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events", carry=["class"])
    return RP.top_anomalies(DT.anomalies(d), d.source, 200)


@det_register("j3_transactions_left_anomalies", "tx_events",
              "SELECT transaction_id, amount, class, if(flagged, round(decision, 6), NULL) AS anomaly_score FROM scored")
def j3_transactions_left_anomalies(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events", carry=["class"])
    tx = d.source.select("transaction_id", "amount", "class")
    return tx.join(DT.anomalies(d).select("transaction_id", "anomaly_score"), "transaction_id", "left")


@det_register("j4_frauds_detected", "tx_events",
              "SELECT count_if(flagged AND class = 1)::BIGINT AS frauds_detected FROM scored")
def j4_frauds_detected(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events", carry=["class"])
    return RP.frauds_detected(d.source, DT.anomalies(d))


@register("j5_orphan_lineitems", """
    SELECT l_orderkey, l_linenumber FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""")
def j5_orphan_lineitems(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("transaction_id"), "l_linenumber")
    parent = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("transaction_id"))
    return RP.orphans(li, parent).select(F.col("transaction_id").alias("l_orderkey"), "l_linenumber")


@register("j5_orphan_results", f"""
    SELECT vr.transaction_id, vr.rule_name FROM {long_sql('tx_docs')} vr
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = vr.transaction_id)""")
def j5_orphan_results(spark, sf_dir):
    res = R.evaluate(view(spark, sf_dir, "tx_docs")).select("transaction_id", "rule_name")
    parent = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("transaction_id"))
    return RP.orphans(res, parent)


@det_register("w1_top15_one_feature", "tx_events", """
    SELECT transaction_id, amount, region, round(decision, 6) AS anomaly_score FROM scored WHERE flagged
    ORDER BY decision ASC NULLS FIRST, transaction_id LIMIT 15""", features=["amount"], scale=False, where=VALID_AMOUNT)
def w1_top15_one_feature(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events", ["amount"], scale=False, valid_amount=True, carry=["region"])
    top = d.scored.where(F.col("flagged")).orderBy(F.col("decision").asc_nulls_first(), "transaction_id").limit(15)
    return top.select("transaction_id", "amount", "region", F.round("decision", 6).alias("anomaly_score"))


@det_register("f4_console_top10", "tx_events", """
    SELECT transaction_id, if(amount < 0, '-$', '$') || format('{:,.2f}', abs(round(amount, 2))) AS amount_text,
           printf('%.4f', round(round(decision, 6), 4)) AS score_text, if(class = 1, 'FRAUD', 'Normal') AS label
    FROM scored WHERE flagged QUALIFY row_number() OVER (ORDER BY round(decision, 6), transaction_id) <= 10""")
def f4_console_top10(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events", carry=["class"])
    return RP.console_top(DT.anomalies(d), d.source, 10)


def _DAY_SPARK():
    return F.expr("date_add(DATE'1998-01-01', CAST(floor(time_elapsed / 86400) AS INT))")


_DAY_SQL = "CAST(DATE '1998-01-01' + CAST(floor(time_elapsed / 86400) AS INTEGER) AS DATE)"


def _history_sql(view_name: str) -> str:
    rs = rule_sql(view_name)
    failed = " + ".join(f"CASE WHEN {e} THEN 0 ELSE 1 END" for e in rs.values())
    return f"""SELECT record_date, round(100 * (1 - failed_checks::DOUBLE / (total_rows * {len(rs)})), 2) AS quality_score,
                      total_rows, failed_checks
               FROM (SELECT {_DAY_SQL} AS record_date, CAST(count(*) AS BIGINT) AS total_rows,
                            CAST(sum({failed}) AS BIGINT) AS failed_checks
                     FROM {view_name} GROUP BY 1)"""


@register("w3_history_ordered", _history_sql("tx_orders") + " ORDER BY record_date NULLS FIRST")
def w3_history_ordered(spark, sf_dir):
    return RP.history_ordered(RP.history_by_day(view(spark, sf_dir, "tx_orders"), _DAY_SPARK()))


@register("w4_latest_score", f"""
    SELECT arg_max(quality_score, record_date) AS quality_score, max(record_date) AS record_date
    FROM ({_history_sql('tx_orders')})""")
def w4_latest_score(spark, sf_dir):
    return RP.latest_score(RP.history_by_day(view(spark, sf_dir, "tx_orders"), _DAY_SPARK()))


@register("w5_head", "SELECT * FROM tx_events ORDER BY transaction_id LIMIT 10")
def w5_head(spark, sf_dir):
    return RP.head(view(spark, sf_dir, "tx_events"), 10)


def _EV_DAY_SPARK():
    return F.expr("date_add(DATE'2024-01-01', CAST(floor(time_elapsed / 86400) AS INT))")


def _overview_sql() -> str:
    rs = rule_sql("tx_events")
    failed = " + ".join(f"CASE WHEN {e} THEN 0 ELSE 1 END" for e in rs.values())
    hist = _history_sql("tx_events").replace("DATE '1998-01-01'", "DATE '2024-01-01'")
    body = f"""
        SELECT CAST(count(*) AS BIGINT) AS total_records, CAST(count(*) * {len(rs)} AS BIGINT) AS total_checks,
               CAST(sum({failed}) AS BIGINT) AS failed_checks,
               CAST(count(*) * {len(rs)} - sum({failed}) AS BIGINT) AS passed_checks,
               (SELECT arg_max(quality_score, record_date) FROM ({hist})) AS quality_score,
               CAST(count_if(flagged) AS BIGINT) AS anomaly_count,
               CAST(count_if(coalesce(class = 1, false)) AS BIGINT) AS total_frauds,
               CAST(count_if(flagged AND coalesce(class = 1, false)) AS BIGINT) AS frauds_detected
        FROM scored"""
    return with_ctes(det_ctes("tx_events", _EV), body)


@register("a7_overview", _overview_sql(), raw=True)
def a7_overview(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events", carry=None)
    latest = RP.latest_score(RP.history_by_day(d.source, _EV_DAY_SPARK()))
    return RP.overview_scored(d.scored, latest)


@register("p2_label_filter", "SELECT transaction_id, amount FROM tx_events WHERE class = 1")
def p2_label_filter(spark, sf_dir):
    return view(spark, sf_dir, "tx_events").where(F.col("class") == 1).select("transaction_id", "amount")


@det_register("p5_flagged_normal_split", "tx_events", """
    SELECT CASE WHEN flagged THEN -1 ELSE 1 END AS prediction, CAST(count(*) AS BIGINT) AS n
    FROM scored WHERE path_units IS NOT NULL GROUP BY 1""")
def p5_flagged_normal_split(spark, sf_dir):
    p = RP.predictions(_detect(spark, sf_dir, "tx_events").scored)
    return p.where(F.col("prediction").isNotNull()).groupBy("prediction").agg(F.count(F.lit(1)).cast("long").alias("n"))


@register("p6_feature_selection", f"SELECT transaction_id, {', '.join(_EV)} FROM tx_events")
def p6_feature_selection(spark, sf_dir):
    return view(spark, sf_dir, "tx_events").select("transaction_id", *_EV)


@det_register("p7_constant_column", "tx_events", "SELECT transaction_id, detection_method FROM an")
def p7_constant_column(spark, sf_dir):
    return DT.anomalies(_detect(spark, sf_dir, "tx_events")).select("transaction_id", "detection_method")


@register("p8_renaming_projection", "SELECT transaction_id, class AS is_fraud FROM tx_orders")
def p8_renaming_projection(spark, sf_dir):
    return view(spark, sf_dir, "tx_orders").select("transaction_id", F.col("class").alias("is_fraud"))


@det_register("p9_flag_status", "tx_events", """
    SELECT transaction_id, ['Not Flagged', 'Flagged'][1 + flagged::INT] AS status FROM scored""")
def p9_flag_status(spark, sf_dir):
    d = _detect(spark, sf_dir, "tx_events")
    return RP.flag_status(d.source, DT.anomalies(d))


@register("p10_amount_bucket", f"SELECT transaction_id, {sql_bucketize('amount')} AS amount_range FROM tx_acct")
def p10_amount_bucket(spark, sf_dir):
    return RP.amount_buckets(view(spark, sf_dir, "tx_acct")).select("transaction_id", "amount_range")


@register("p11_label_text",
          "SELECT transaction_id, CASE WHEN class = 1 THEN 'FRAUD' ELSE 'Normal' END AS label FROM tx_events")
def p11_label_text(spark, sf_dir):
    from vigil.functions.fmt import label_text
    return view(spark, sf_dir, "tx_events").select("transaction_id", label_text("class").alias("label"))


@det_register("p12_scatter", "tx_events", """
    SELECT transaction_id, amount, round(decision, 6) AS anomaly_score, flagged, class AS is_fraud FROM scored""")
def p12_scatter(spark, sf_dir):
    return RP.scatter(_detect(spark, sf_dir, "tx_events", carry=["class"]).scored)


# --------------------------------------------------------------------------
# Sources and sinks, queried as write-then-read-back
# --------------------------------------------------------------------------
from vigil.functions.nulls import nan_to_null  # noqa: E402
from vigil.sources import tables as TB  # noqa: E402
from vigil.sources.ids import with_dense_id  # noqa: E402

_CARD_N = 3   # the events view offers three anonymous features v1..v3


def _card_layout(df):
    """tx_events in the card CSV layout: Time, V1..V3, Amount, Class."""
    return df.select(F.col("time_elapsed").alias("Time"), *[F.col(f"v{i}").alias(f"V{i}") for i in range(1, _CARD_N + 1)],
                     F.col("amount").alias("Amount"), F.col("class").cast("double").alias("Class"))


def _card_csv(spark, sf_dir, view_name: str = "tx_events") -> str:
    path = scratch_dir(spark, "card_csv")
    CSV.write_csv(_card_layout(view(spark, sf_dir, view_name)), path)
    return path


_CARD_SQL_COLS = ('time_elapsed AS "Time", v1 AS "V1", v2 AS "V2", v3 AS "V3", amount AS "Amount", '
                  'CAST(class AS DOUBLE) AS "Class"')


@register("s1_csv_scan", f"SELECT {_CARD_SQL_COLS} FROM tx_events")
def s1_csv_scan(spark, sf_dir):
    return CSV.read_csv(spark, _card_csv(spark, sf_dir), SCH.card_csv_schema(_CARD_N))


@register("s2_dense_ids", "SELECT event_id + 1 AS transaction_id, event_id FROM events")
def s2_dense_ids(spark, sf_dir):
    return with_dense_id(table(spark, sf_dir, "events").select("event_id"))


@register("s3_rename_columns",
          "SELECT time_elapsed, v1, v2, v3, amount, CAST(class AS DOUBLE) AS class FROM tx_events")
def s3_rename_columns(spark, sf_dir):
    return CSV.read_card_csv(spark, _card_csv(spark, sf_dir), _CARD_N)


@register("s4_typed_narrowing", """
    SELECT CAST(CAST(time_elapsed AS FLOAT) AS DOUBLE) AS time_elapsed,
           CAST(CAST(v1 AS FLOAT) AS DOUBLE) AS v1, CAST(CAST(v2 AS FLOAT) AS DOUBLE) AS v2,
           CAST(CAST(v3 AS FLOAT) AS DOUBLE) AS v3,
           CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS amount, CAST(class AS INTEGER) AS class
    FROM tx_events""")
def s4_typed_narrowing(spark, sf_dir):
    card = CSV.read_card_csv(spark, _card_csv(spark, sf_dir), _CARD_N)
    raw = CSV.to_raw_table(card.withColumn("transaction_id", F.lit(0).cast("long")), _CARD_N)
    return raw.select(*[F.col(c).cast("double").alias(c) for c in ["time_elapsed", "v1", "v2", "v3", "amount"]],
                      F.col("class").cast("int").alias("class"))


def _results_sql(view_name: str) -> str:
    parts = [f"SELECT transaction_id * 5 + {i} AS id, transaction_id, '{n}' AS rule_name, {e} AS rule_passed FROM {view_name}"
             for i, (n, e) in enumerate(rule_sql(view_name).items())]
    return " UNION ALL ".join(parts)


@register("s5_define_tables", _results_sql("tx_docs"))
def s5_define_tables(spark, sf_dir):
    root = scratch_dir(spark, "tables")
    paths = TB.create_tables(spark, root)
    TB.write_table(R.results_table(view(spark, sf_dir, "tx_docs")), paths["validation_results"],
                   mode="append", schema=SCH.VALIDATION_RESULTS)
    return TB.read_table(spark, paths["validation_results"], schema=SCH.VALIDATION_RESULTS)


@register("s6_full_refresh", _results_sql("tx_docs"))
def s6_full_refresh(spark, sf_dir):
    path = scratch_dir(spark, "validation_results")
    res = R.results_table(view(spark, sf_dir, "tx_docs"))
    TB.write_table(res, path, mode="overwrite", schema=SCH.VALIDATION_RESULTS)
    TB.write_table(res, path, mode="overwrite", schema=SCH.VALIDATION_RESULTS)   # a re-run replaces, never doubles
    return TB.read_table(spark, path, schema=SCH.VALIDATION_RESULTS)


def _history_row_sql(view_name: str, day: str) -> str:
    rs = rule_sql(view_name)
    failed = " + ".join(f"CASE WHEN {e} THEN 0 ELSE 1 END" for e in rs.values())
    return f"""SELECT DATE '{day}' AS record_date,
                      round(100 * (1 - failed_checks::DOUBLE / (total_rows * {len(rs)})), 2) AS quality_score,
                      total_rows, failed_checks
               FROM (SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(sum({failed}) AS BIGINT) AS failed_checks
                     FROM {view_name}) WHERE total_rows > 0"""


@register("s7_append_history",
          _history_row_sql("tx_docs", "2024-06-30") + " UNION ALL " + _history_row_sql("tx_acct", "2024-07-01"))
def s7_append_history(spark, sf_dir):
    path = scratch_dir(spark, "data_quality_history")
    TB.create_tables(spark, path.rsplit("/", 1)[0] + "/" + path.rsplit("/", 1)[1], {"h": SCH.QUALITY_HISTORY})
    hpath = TB.table_path(path, "h")
    TB.write_table(Q.history_row(view(spark, sf_dir, "tx_docs"), record_date="2024-06-30"), hpath,
                   mode="append", schema=SCH.QUALITY_HISTORY)
    TB.write_table(Q.history_row(view(spark, sf_dir, "tx_acct"), record_date="2024-07-01"), hpath,
                   mode="append", schema=SCH.QUALITY_HISTORY)
    return TB.read_table(spark, hpath, schema=SCH.QUALITY_HISTORY)


@register("s8_chunked_write", summary_sql("tx_orders"))
def s8_chunked_write(spark, sf_dir):
    path = scratch_dir(spark, "results_chunked")
    TB.write_table(R.results_table(view(spark, sf_dir, "tx_orders")), path, mode="overwrite",
                   schema=SCH.VALIDATION_RESULTS, max_records_per_file=10000)
    return Q.summary_long(TB.read_table(spark, path, ["rule_name", "rule_passed"]))


def _stored_events(spark, sf_dir) -> str:
    path = scratch_dir(spark, "raw_transactions")
    TB.write_table(view(spark, sf_dir, "tx_events"), path, mode="overwrite")
    return path


@register("s9_pruned_scan", "SELECT transaction_id, amount, v1, v2, v3, class FROM tx_events")
def s9_pruned_scan(spark, sf_dir):
    return TB.read_table(spark, _stored_events(spark, sf_dir), ["transaction_id", "amount", "v1", "v2", "v3", "class"])


@register("s10_full_scan", "SELECT * FROM tx_events")
def s10_full_scan(spark, sf_dir):
    return TB.read_table(spark, _stored_events(spark, sf_dir))


_SUMMARY_SCHEMA = "rule_name string, passed long, failed long"


@register("s11_json_report", summary_sql("tx_acct"))
def s11_json_report(spark, sf_dir):
    path = scratch_dir(spark, "validation_summary_json")
    TB.write_report(Q.summary_fused(view(spark, sf_dir, "tx_acct")), path, order_by=["rule_name"])
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(_SUMMARY_SCHEMA)
    return TB.read_json_report(spark, path, schema)


@register("s12_nan_to_null", """
    SELECT transaction_id, CASE WHEN amount < 0 OR amount > 9000 THEN NULL ELSE amount END AS ratio FROM tx_acct""")
def s12_nan_to_null(spark, sf_dir):
    df = view(spark, sf_dir, "tx_acct")
    ratio = (F.when(F.col("amount") < 0, F.lit(float("nan")))
              .when(F.col("amount") > 9000, F.lit(float("inf"))).otherwise(F.col("amount")))
    return nan_to_null(df.select("transaction_id", ratio.alias("ratio")))


@register("s13_bi_handoff", summary_sql("tx_orders"))
def s13_bi_handoff(spark, sf_dir):
    path = scratch_dir(spark, "bi_validation_summary")
    TB.publish(Q.summary_fused(view(spark, sf_dir, "tx_orders")), path)
    return TB.read_table(spark, path)


from vigil import catalog_store  # noqa: E402,F401  (registers the queries over stored tables)
