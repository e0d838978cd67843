"""Report tables over (transactions, check results, outliers, history).

Two shapes are offered where it matters:
* generic joins over stored tables (the outlier table may hold several rows
  per transaction, one per detector, and counts then fan out as a SQL join
  does). The outlier side is pre-aggregated to one row per key before the
  join, and the join strategy is left to the planner / AQE, which only turns
  it into a broadcast when the runtime size is under its threshold;
* fused single-scan forms over a detector's scored frame, which already has
  the flag on every row and needs no join at all.

Top-k reports cut to k rows before joining, so the joined side is k rows
(a bounded broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.buckets import AMOUNT_CUTS, AMOUNT_LABELS, bucketize
from vigil.functions.fmt import currency, label_text
from vigil.operators.quality import score_expr
from vigil.operators.rules import DEFAULT_RULES, evaluate_wide

FLAGGED, NOT_FLAGGED = "Flagged", "Not Flagged"


def _per_key(anoms: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per transaction with the number of outlier rows (map-side partial count)."""
    return anoms.groupBy(key).agg(F.count(F.lit(1)).alias("_hits"))


def with_flag_status(tx: DataFrame, anoms: DataFrame, key: str = "transaction_id") -> DataFrame:
    """tx LEFT JOIN outliers: adds `_hits` (fan-out weight) and `status`."""
    j = tx.join(_per_key(anoms, key), key, "left")
    return j.withColumn("status", F.when(F.col("_hits").isNotNull(), F.lit(FLAGGED)).otherwise(F.lit(NOT_FLAGGED)))


def flag_status(tx: DataFrame, anoms: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Per transaction: (transaction_id, status) with 'Flagged' / 'Not Flagged'."""
    return with_flag_status(tx, anoms, key).select(key, "status")


def fraud_breakdown(tx: DataFrame, anoms: DataFrame, label_col: str = "class", method: str | None = None) -> DataFrame:
    """Counts by (is_fraud, status), as COUNT(*) over tx LEFT JOIN outliers: a row flagged by two detectors counts twice.

    `method` takes the outliers of one detector, and each row counts once.
    """
    j = with_flag_status(tx, of_method(anoms, method))
    return (j.groupBy(F.col(label_col).alias("is_fraud"), "status")
             .agg(F.sum(F.coalesce(F.col("_hits"), F.lit(1))).cast("long").alias("cnt")))


def fraud_breakdown_scored(scored: DataFrame, label_col: str = "class") -> DataFrame:
    """Same counts from a scored frame (one detector): one scan, no join."""
    status = F.when(F.col("flagged"), F.lit(FLAGGED)).otherwise(F.lit(NOT_FLAGGED))
    return scored.groupBy(F.col(label_col).alias("is_fraud"), status.alias("status")) \
                 .agg(F.count(F.lit(1)).cast("long").alias("cnt"))


def amount_distribution(tx: DataFrame, anoms: DataFrame, amount_col: str = "amount",
                        cuts=AMOUNT_CUTS, labels=AMOUNT_LABELS, keep_min: bool = False, method: str | None = None) -> DataFrame:
    """Per amount range: total rows and flagged rows, ordered by the range's smallest amount (kept as `_min` if asked).

    Rows flagged by several detectors count as in `fraud_breakdown`.
    """
    j = with_flag_status(tx, of_method(anoms, method))
    w = F.coalesce(F.col("_hits"), F.lit(1))
    return (j.groupBy(bucketize(amount_col, cuts, labels).alias("amount_range"))
             .agg(F.sum(w).cast("long").alias("total"),
                  F.sum(F.when(F.col("_hits").isNotNull(), F.col("_hits")).otherwise(0)).cast("long").alias("anomalies"),
                  F.min(amount_col).alias("_min"))
             .orderBy(F.col("_min").asc_nulls_first()).drop(*[] if keep_min else ["_min"]))


def amount_distribution_scored(scored: DataFrame, amount_col: str = "amount",
                               cuts=AMOUNT_CUTS, labels=AMOUNT_LABELS) -> DataFrame:
    """Same rows from a scored frame (one detector): one aggregate, no join."""
    return (scored.groupBy(bucketize(amount_col, cuts, labels).alias("amount_range"))
                  .agg(F.count(F.lit(1)).cast("long").alias("total"), F.count_if("flagged").cast("long").alias("anomalies"),
                       F.min(amount_col).alias("_min"))
                  .orderBy(F.col("_min").asc_nulls_first()).drop("_min"))


def amount_buckets(df: DataFrame, amount_col: str = "amount") -> DataFrame:
    return df.withColumn("amount_range", bucketize(amount_col))


def frauds_detected(tx: DataFrame, anoms: DataFrame, label_col: str = "class") -> DataFrame:
    """COUNT(*) of outliers INNER JOIN transactions WHERE label = 1."""
    pos = tx.where(F.col(label_col) == 1).select("transaction_id")
    return anoms.join(pos, "transaction_id", "inner").agg(F.count(F.lit(1)).cast("long").alias("frauds_detected"))


def orphans(child: DataFrame, parent: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Child rows whose key has no parent row (a foreign-key check)."""
    return child.join(parent.select(key), key, "left_anti")


def top_anomalies(anoms: DataFrame, tx: DataFrame, k: int = 200, label_col: str = "class") -> DataFrame:
    """Lowest scores first (ties by transaction_id), with amount and label.

    The cut to k rows happens before the join: the k-row side is broadcast
    (bounded by k), and the transaction table is only probed.
    """
    top = anoms.orderBy(F.col("anomaly_score").asc_nulls_first(), "transaction_id").limit(k)
    info = tx.select("transaction_id", "amount", F.col(label_col).alias("is_fraud"))
    return (info.join(F.broadcast(top), "transaction_id", "right")
                .select("transaction_id", "anomaly_score", "detection_method", "amount", "is_fraud")
                .orderBy(F.col("anomaly_score").asc_nulls_first(), "transaction_id"))


def console_top(anoms: DataFrame, tx: DataFrame, k: int = 10, label_col: str = "class") -> DataFrame:
    """Top-k as text fields: `$1,234.56`, score with 4 decimals, FRAUD/Normal."""
    t = top_anomalies(anoms, tx, k, label_col)
    return t.select("transaction_id",
                    currency("amount").alias("amount_text"),
                    F.format_string("%.4f", F.col("anomaly_score")).alias("score_text"),
                    label_text("is_fraud").alias("label"))


def anomalies_by_region(scored: DataFrame, region_col: str = "region") -> DataFrame:
    """Counts among flagged rows per region, sorted by region."""
    return (scored.where(F.col("flagged") & F.col(region_col).isNotNull()).groupBy(region_col)
                  .agg(F.count(F.lit(1)).cast("long").alias("count")).orderBy(region_col))


def scatter(scored: DataFrame, label_col: str = "class", digits: int = 6) -> DataFrame:
    """Per row: amount, decision score, flag, label (plot input)."""
    return scored.select("transaction_id", "amount", F.round("decision", digits).alias("anomaly_score"),
                         F.col("flagged"), F.col(label_col).alias("is_fraud"))


def predictions(scored: DataFrame) -> DataFrame:
    """-1 for flagged rows, 1 for the rest (rows without a score: NULL)."""
    return scored.select("transaction_id", "path_units",
                         F.when(F.col("path_units").isNull(), F.lit(None))
                          .when(F.col("flagged"), F.lit(-1)).otherwise(F.lit(1)).alias("prediction"))


# ------------------------------------------------------------------ history
def history_by_day(df: DataFrame, date_col, rules=DEFAULT_RULES) -> DataFrame:
    """One score-history row per day of the data (record_date, quality_score, total_rows, failed_checks)."""
    wide = evaluate_wide(df.withColumn("record_date", date_col), rules, keep=["record_date"])
    failed = sum((F.when(~F.col(r.name), 1).otherwise(0) for r in rules), F.lit(0))
    g = wide.groupBy("record_date").agg(F.count(F.lit(1)).cast("long").alias("total_rows"),
                                        F.sum(failed).cast("long").alias("failed_checks"))
    return g.select("record_date", score_expr(F.col("failed_checks"), F.col("total_rows") * len(rules)).alias("quality_score"),
                    "total_rows", "failed_checks")


def history_ordered(history: DataFrame) -> DataFrame:
    """By date; several runs of one date by the time of the run."""
    runs = [c for c in ("run_at", "run_id") if c in history.columns]
    return history.orderBy(F.col("record_date").asc_nulls_first(), *runs)


def latest_score(history: DataFrame) -> DataFrame:
    """Score of the latest record_date, of its runs the latest; NULL on an empty history."""
    # Without runs, of several scores of one day: the one over most rows, then most failures, then the highest.
    runs = [c for c in ("run_at", "run_id") if c in history.columns]
    order = F.struct("record_date", *runs, "total_rows", "failed_checks", "quality_score")
    return history.agg(F.max_by("quality_score", order).alias("quality_score"),
                       F.max("record_date").alias("record_date"))


def of_method(anoms: DataFrame, method: str | None) -> DataFrame:
    """The outliers of one detector, or of all."""
    return anoms if method is None else anoms.where(F.col("detection_method") == method)


def head(df: DataFrame, n: int = 10, order_by: str = "transaction_id") -> DataFrame:
    return df.orderBy(order_by).limit(n)


# ----------------------------------------------------------------- overview
def overview_scored(scored: DataFrame, latest: DataFrame | None = None, rules=DEFAULT_RULES,
                    label_col: str = "class") -> DataFrame:
    """The 8 overview fields from one scan of a detector's scored frame.

    Rows, checks (rules re-evaluated on the same rows), flagged rows, labels
    and caught labels are all conditional counts of a single aggregate. The
    latest history score, when given, is one more one-row statistic.
    """
    wide = evaluate_wide(scored, rules, keep=["flagged", label_col])
    failed = sum((F.when(~F.col(r.name), 1).otherwise(0) for r in rules), F.lit(0))
    pos = F.coalesce(F.col(label_col) == 1, F.lit(False))
    one = wide.agg(F.count(F.lit(1)).cast("long").alias("total_records"),
                   F.coalesce(F.sum(failed), F.lit(0)).cast("long").alias("failed_checks"),
                   F.count_if(F.col("flagged")).cast("long").alias("anomaly_count"),
                   F.count_if(pos).cast("long").alias("total_frauds"),
                   F.count_if(F.col("flagged") & pos).cast("long").alias("frauds_detected"))
    score = None
    if latest is not None:
        score = latest.first()["quality_score"]
    n_rules = len(rules)
    return one.select(
        "total_records",
        (F.col("total_records") * n_rules).alias("total_checks"),
        "failed_checks",
        (F.col("total_records") * n_rules - F.col("failed_checks")).alias("passed_checks"),
        F.lit(score).cast("double").alias("quality_score"),
        "anomaly_count", "total_frauds", "frauds_detected",
    )
