"""Report semantics: fan-out, orphans, ties at the top-k limit, identities."""

from pyspark.sql import functions as F

from conftest import SF
from vigil.operators import detect as DT
from vigil.operators import reports as RP
from vigil.sources.views import view

TX = "transaction_id long, amount double, class int"
AN = "id long, transaction_id long, anomaly_score double, detection_method string"


def test_fan_out_and_orphans(spark):
    tx = spark.createDataFrame([(1, 5.0, 0), (2, 20.0, 1), (3, 7000.0, 0)], TX)
    an = spark.createDataFrame([(10, 2, -0.1, "A"), (11, 2, -0.2, "B"), (12, 9, -0.3, "A")], AN)
    br = {(r["is_fraud"], r["status"]): r["cnt"] for r in RP.fraud_breakdown(tx, an).collect()}
    assert br == {(0, "Not Flagged"): 2, (1, "Flagged"): 2}       # two detector rows for tx 2 count twice
    dist = {r["amount_range"]: (r["total"], r["anomalies"]) for r in RP.amount_distribution(tx, an).collect()}
    assert dist == {"$0-10": (1, 0), "$10-50": (2, 2), "$5K+": (1, 0)}
    assert [r["transaction_id"] for r in RP.orphans(an, tx).collect()] == [9]
    assert RP.frauds_detected(tx, an).first()["frauds_detected"] == 2


def test_ties_at_limit(spark):
    tx = spark.createDataFrame([(i, 1.0, 0) for i in range(1, 6)], TX)
    an = spark.createDataFrame([(i, i, -0.5 if i in (2, 4, 5) else -0.1, "A") for i in range(1, 6)], AN)
    top = [r["transaction_id"] for r in RP.top_anomalies(an, tx, 2).collect()]
    assert top == [2, 4]


def test_identities_on_detector(spark):
    d = DT.detect(view(spark, SF, "tx_events"), ["amount", "v1", "v2", "v3"])
    an = DT.anomalies(d)
    tx = view(spark, SF, "tx_events")
    n = tx.count()
    br = RP.fraud_breakdown(tx, an).collect()
    assert sum(r["cnt"] for r in br) == n
    assert sum(r["cnt"] for r in br if r["status"] == "Flagged") == an.count()
    fused = {(r["is_fraud"], r["status"]): r["cnt"] for r in RP.fraud_breakdown_scored(d.scored).collect()}
    assert fused == {(r["is_fraud"], r["status"]): r["cnt"] for r in br}
    dist = RP.amount_distribution(tx, an).collect()
    assert sum(r["total"] for r in dist) == n and sum(r["anomalies"] for r in dist) == an.count()
    o = RP.overview_scored(d.scored).first()
    assert o["passed_checks"] + o["failed_checks"] == o["total_checks"] == 5 * n
    assert o["anomaly_count"] == an.count()


def test_latest_score_empty(spark):
    h = spark.createDataFrame([], "record_date date, quality_score double, total_rows long, failed_checks long")
    assert RP.latest_score(h).first()["quality_score"] is None
