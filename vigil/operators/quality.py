"""Check summaries and the quality score.

The fused summaries count over the wide booleans (one scan, one partial +
final aggregate of a single row) instead of the N x R long rows; sums over
the long form equal sums over the wide columns, so both paths give the same
numbers. The long-form variants exist for stored result tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.rules import DEFAULT_RULES, evaluate_wide


def _count_true(c: Column) -> Column:
    return F.count_if(c).cast("long")


def summary_fused(df: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """Per rule: (rule_name, passed, failed), ordered by rule name."""
    wide = evaluate_wide(df, rules, keep=[])
    aggs = []
    for r in rules:
        aggs += [_count_true(F.col(r.name)).alias(f"p_{r.name}"), _count_true(~F.col(r.name)).alias(f"f_{r.name}")]
    one = wide.agg(*aggs)
    pairs = ", ".join(f"'{r.name}', `p_{r.name}`, `f_{r.name}`" for r in rules)
    return one.select(F.expr(f"stack({len(rules)}, {pairs}) AS (rule_name, passed, failed)")).orderBy("rule_name")


def summary_long(long_results: DataFrame) -> DataFrame:
    """Same as `summary_fused`, from a stored long result table."""
    p = F.col("rule_passed")
    return (long_results.groupBy("rule_name")
            .agg(_count_true(p).alias("passed"), _count_true(~p).alias("failed"))
            .orderBy("rule_name"))


def failures_by_rule(summary: DataFrame) -> DataFrame:
    """Rules with at least one failure: (rule_name, failed), names ascending."""
    return summary.where(F.col("failed") > 0).select("rule_name", "failed").orderBy("rule_name")


def check_totals(summary: DataFrame) -> DataFrame:
    """One row: total_checks, passed_checks, failed_checks."""
    return summary.agg(
        F.coalesce(F.sum(F.col("passed") + F.col("failed")), F.lit(0)).cast("long").alias("total_checks"),
        F.coalesce(F.sum("passed"), F.lit(0)).cast("long").alias("passed_checks"),
        F.coalesce(F.sum("failed"), F.lit(0)).cast("long").alias("failed_checks"),
    )


def score_expr(failed: Column, total: Column) -> Column:
    """round(100 * (1 - failed/total), 2); NULL when there are no checks."""
    return F.round(F.lit(100.0) * (F.lit(1.0) - F.try_divide(failed.cast("double"), total.cast("double"))), 2)


def quality_score(totals: DataFrame) -> DataFrame:
    return totals.withColumn("quality_score", score_expr(F.col("failed_checks"), F.col("total_checks")))


def pass_rates(summary: DataFrame) -> DataFrame:
    """Per rule pass rate in percent, 2 decimals."""
    total = F.col("passed") + F.col("failed")
    return summary.select(
        "rule_name", "passed", "failed",
        F.round(F.lit(100.0) * F.try_divide(F.col("passed").cast("double"), total.cast("double")), 2).alias("pass_rate"),
    ).orderBy("rule_name")


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("long").alias(name))


def history_row(df: DataFrame, rules=DEFAULT_RULES, record_date: _dt.date | str | None = None) -> DataFrame:
    """One score-history row (record_date, quality_score, total_rows, failed_checks).

    A single pass: rows and failed checks are counted in the same aggregate.
    No row when there are no checks (empty input).
    """
    wide = evaluate_wide(df, rules, keep=[])
    failed = sum((F.when(~F.col(r.name), 1).otherwise(0) for r in rules), F.lit(0))
    one = wide.agg(F.count(F.lit(1)).cast("long").alias("total_rows"),
                   F.coalesce(F.sum(failed), F.lit(0)).cast("long").alias("failed_checks"))
    date_col = F.current_date() if record_date is None else F.lit(str(record_date)).cast("date")
    total_checks = F.col("total_rows") * F.lit(len(rules))
    return (one.where(total_checks > 0)
               .select(date_col.alias("record_date"),
                       score_expr(F.col("failed_checks"), total_checks).alias("quality_score"),
                       "total_rows", "failed_checks"))


def with_run(history: DataFrame, run_id: str, run_at: _dt.datetime | str | None = None) -> DataFrame:
    """History rows with the run that wrote them (run_at: now, if not given)."""
    at = F.current_timestamp() if run_at is None else F.lit(str(run_at)).cast("timestamp")
    return history.withColumn("run_at", at).withColumn("run_id", F.lit(run_id))
