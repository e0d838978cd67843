"""The composed batch jobs and the incremental stream on data derived from the test tables."""

import glob
import json

from pyspark.sql import functions as F

from conftest import SF
from vigil.catalog import _card_layout
from vigil.operators import iforest as IF
from vigil.plans import jobs as J
from vigil.session import scratch_dir
from vigil.sources import csv as CSV
from vigil.sources.views import view
from vigil.streaming import incremental as INC


def _report(path):
    return json.loads("".join(open(p).read() for p in glob.glob(f"{path}/part-*")))


def test_batch_jobs_end_to_end(spark):
    csv_path = scratch_dir(spark, "card_csv")
    CSV.write_csv(_card_layout(view(spark, SF, "tx_acct").withColumn("v2", F.lit(1.0)).withColumn("v3", F.col("v1") * 2)),
                  csv_path)
    root, out = scratch_dir(spark, "tables"), scratch_dir(spark, "reports")
    res = J.run_all(spark, csv_path, root, out, n_features=3, record_date="2024-06-30",
                    features=["amount", "v1", "v3"], params=IF.ForestParams(trees=20, sample_size=64))
    ov = _report(res["reports"]["overview"])[0]
    assert ov["total_records"] == 1500 and ov["total_checks"] == 7500
    assert ov["passed_checks"] + ov["failed_checks"] == ov["total_checks"]
    assert ov["failed_checks"] == 122                     # negative balances fail non_negative_amount
    summ = {r["rule_name"]: r for r in _report(res["reports"]["validation_summary"])}
    assert summ["non_negative_amount"]["failed"] == 122
    stats = _report(res["reports"]["fraud_detection_stats"])
    assert sum(r["cnt"] for r in stats) == 1500
    assert sum(r["cnt"] for r in stats if r["status"] == "Flagged") == ov["anomaly_count"]
    dist = _report(res["reports"]["amount_distribution"])
    assert [r["amount_range"] for r in dist] == ["$0-10", "$10-50", "$50-100", "$100-500", "$500-1K", "$1K-5K", "$5K+"]
    assert set(dist[0]) == {"amount_range", "total", "anomalies"}
    top = _report(res["reports"]["anomalies"])
    assert [r["anomaly_score"] for r in top] == sorted(r["anomaly_score"] for r in top)
    assert len(_report(res["reports"]["validation_errors"])) == 122
    hist = [json.loads(x) for p in glob.glob(f"{res['reports']['quality_history']}/part-*") for x in open(p)]
    assert hist[0]["record_date"] == "2024-06-30" and hist[0]["quality_score"] == ov["quality_score"]


def test_incremental_stream(spark):
    src = scratch_dir(spark, "landing")
    tx = view(spark, SF, "tx_acct")
    tx.where("transaction_id < 700").write.parquet(f"{src}/a")
    schema = tx.schema
    checked = INC.checked_stream(spark, f"{src}/*", schema)
    results, hist, ck = scratch_dir(spark, "s_res"), scratch_dir(spark, "s_hist"), scratch_dir(spark, "s_ck")
    q = INC.write_batches(checked, results, hist, ck)
    q.processAllAvailable()
    tx.where("transaction_id >= 700").write.parquet(f"{src}/b")
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(results)
    assert got.count() == 5 * 1500
    assert got.where("rule_name = 'non_negative_amount' AND NOT rule_passed").count() == 122
    h = spark.read.parquet(hist)
    assert h.agg(F.sum("total_rows")).first()[0] == 1500
