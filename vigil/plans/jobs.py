"""The four batch jobs of the checking system, composed from the operators.

validate  card CSV -> raw_transactions (narrowed) + validation_results + quarantined lines and line counts
score     validation_results -> one data_quality_history row per run
detect    raw_transactions -> anomalies (flagged rows only, full refresh)
export    stored tables -> report documents (JSON arrays, one per report)

Tables live in a store under `root` (a shared folder on a cluster). Every job
reads what the previous one committed and commits all that it writes in one
step, so each can be re-run alone, a job that fails changes nothing, and
readers never see half a table or a raw table beside the results of another.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import schemas as SCH
from vigil.operators import detect as DT
from vigil.operators import iforest as IF
from vigil.operators import quality as Q
from vigil.operators import reports as RP
from vigil.operators import rules as R
from vigil.session import scratch_dir
from vigil.sources import csv as CSV
from vigil.sources import tables as TB
from vigil.sources.store import Store

# Detector features and report sizes of the checking system.
DETECT_FEATURES = ["amount", "v1", "v2", "v3", "v4", "v5", "v6", "v7", "v14", "v17"]
ERRORS_LIMIT = 500
TOP_ANOMALIES = 200


def open_store(spark: SparkSession, root: str, n_features: int = SCH.N_CARD_FEATURES) -> Store:
    return Store(spark, root, SCH.store_schemas(n_features))


def validate(spark: SparkSession, load: CSV.Load, root: str, rules=R.DEFAULT_RULES,
             n_features: int = SCH.N_CARD_FEATURES) -> DataFrame:
    """Checks on source types, then narrowing for storage; returns the per-rule summary.

    Ids number the source's lines. The rows with their rule results are
    staged once, so the raw table and the result table come from the same
    rows, and each of the two writes reads back only the columns it needs.
    """
    staged = scratch_dir(spark, "validated")
    R.evaluate_wide(load.rows, rules).write.parquet(staged)
    wide = spark.read.parquet(staged)
    results = R.results_table(wide.select("transaction_id", *[r.name for r in rules]),
                              [R.Rule(r.name, lambda df, n=r.name: F.col(n)) for r in rules])
    store = open_store(spark, root, n_features)
    store.refresh({"raw_transactions": CSV.to_raw_table(wide, n_features), "validation_results": results,
                   "quarantine": load.quarantine, "load_counts": load.counts})
    return Q.summary_long(store.read("validation_results", ["rule_name", "rule_passed"]))


def validate_csv(spark: SparkSession, csv_path: str, root: str, n_features: int = SCH.N_CARD_FEATURES) -> DataFrame:
    return validate(spark, CSV.load_card_csv(spark, csv_path, n_features), root, n_features=n_features)


def score(spark: SparkSession, root: str, record_date: _dt.date | str | None = None, run_id: str | None = None,
          run_at: _dt.datetime | str | None = None) -> DataFrame | None:
    """Appends the score of this run, dated today or `record_date`; nothing when there are no checks.

    A run id that is in the history already adds nothing, so a job scheduler
    may repeat a run.
    """
    store = open_store(spark, root)
    totals = store.read("validation_results", ["rule_passed"]).agg(
        F.count(F.lit(1)).cast("long").alias("total_checks"), F.count_if(~F.col("rule_passed")).cast("long").alias("failed_checks"))
    one = totals.first()
    if one["total_checks"] == 0:
        return None
    rows = store.read("load_counts", ["loaded"]).first()["loaded"]
    date_col = F.current_date() if record_date is None else F.lit(str(record_date)).cast("date")
    row = spark.createDataFrame([(one["failed_checks"], one["total_checks"], rows)],
                                "failed_checks long, total_checks long, total_rows long")
    hist = row.select(date_col.alias("record_date"),
                      Q.score_expr(F.col("failed_checks"), F.col("total_checks")).alias("quality_score"),
                      "total_rows", "failed_checks")
    run_id = run_id or uuid.uuid4().hex
    store.append("data_quality_history", Q.with_run(hist, run_id, run_at), run_id)
    return hist


def detect(spark: SparkSession, root: str, features=DETECT_FEATURES, params: IF.ForestParams = IF.ForestParams(),
           n_features: int = SCH.N_CARD_FEATURES) -> DataFrame:
    """Scale, fit, score, cut; stores flagged rows (full refresh); returns the metrics row."""
    store = open_store(spark, root, n_features)
    det = DT.detect(store.read("raw_transactions", ["transaction_id", *features, "class"]), features, params=params)
    store.refresh({"anomalies": DT.anomalies(det)})
    return DT.metrics(det)


def export(spark: SparkSession, root: str, out_dir: str, n_features: int = SCH.N_CARD_FEATURES) -> dict[str, str]:
    """Writes the report documents (the history, which grows, as JSON lines, the others as arrays); returns report name -> folder."""
    store = open_store(spark, root, n_features)
    tx = store.read("raw_transactions", ["transaction_id", "amount", "class"]) \
        .withColumn("amount", F.col("amount").cast("double"))
    res = store.read("validation_results")
    an = store.read("anomalies")
    hist = store.read("data_quality_history")
    out = {}

    def put(name, df, order, form="array"):
        path = f"{out_dir.rstrip('/')}/{name}"
        TB.write_report(df, path, order, form)
        out[name] = path

    put("quality_history", hist.select(F.col("record_date").cast("string").alias("record_date"), "quality_score", "total_rows", "failed_checks",
                                       F.col("run_at").alias("_run_at"), F.col("run_id").alias("_run_id")), ["record_date", "_run_at", "_run_id"], "lines")
    summary = Q.summary_long(res)
    put("validation_summary", summary, ["rule_name"])
    put("load_counts", store.read("load_counts"), ["lines"])
    # The first failures are picked before the join, which then reads that many rows of one side.
    first = R.failures(res).orderBy("transaction_id", "rule_name").limit(ERRORS_LIMIT)
    errors = first.join(tx.select("transaction_id", "amount"), "transaction_id", "left").select("transaction_id", "rule_name", "amount")
    put("validation_errors", errors, ["transaction_id", "rule_name"])
    put("anomalies", RP.top_anomalies(an, tx, TOP_ANOMALIES), ["anomaly_score", "transaction_id"])
    totals = Q.check_totals(summary).first()
    latest = RP.latest_score(hist).first()["quality_score"]
    counts = tx.agg(F.count(F.lit(1)).cast("long").alias("total_records"),
                    F.count_if(F.col("class") == 1).cast("long").alias("total_frauds")).first()
    overview = spark.createDataFrame([(
        counts["total_records"], totals["total_checks"], totals["failed_checks"], totals["passed_checks"], latest,
        an.count(), counts["total_frauds"], RP.frauds_detected(tx, an).first()["frauds_detected"],
    )], "total_records long, total_checks long, failed_checks long, passed_checks long, quality_score double, "
        "anomaly_count long, total_frauds long, frauds_detected long")
    put("overview", overview, ["total_records"])
    put("fraud_detection_stats", RP.fraud_breakdown(tx, an), ["is_fraud", "status"])
    put("amount_distribution", RP.amount_distribution(tx, an, keep_min=True), ["_min"])
    return out


def run_all(spark: SparkSession, csv_path: str, root: str, out_dir: str, n_features: int = SCH.N_CARD_FEATURES,
            record_date=None, features=DETECT_FEATURES, params: IF.ForestParams = IF.ForestParams(),
            run_id: str | None = None, run_at=None) -> dict:
    summary = validate_csv(spark, csv_path, root, n_features).collect()
    score(spark, root, record_date, run_id, run_at)
    metrics = detect(spark, root, features, params, n_features).first()
    reports = export(spark, root, out_dir, n_features)
    return {"summary": summary, "metrics": metrics, "reports": reports}


def main(argv=None) -> None:
    import argparse
    ap = argparse.ArgumentParser(description="validate, score, detect and report on a card-layout CSV")
    ap.add_argument("--csv", required=True)
    ap.add_argument("--root", required=True, help="shared folder for the tables")
    ap.add_argument("--out", required=True, help="folder for the report documents")
    ap.add_argument("--features", type=int, default=SCH.N_CARD_FEATURES)
    a = ap.parse_args(argv)
    from vigil.session import get_spark
    res = run_all(get_spark(), a.csv, a.root, a.out, a.features)
    print(res["metrics"])


if __name__ == "__main__":
    main()
