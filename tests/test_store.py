"""Stores: refreshes as a whole, appends by run, versions; quarantined lines; ids over files; bucketed joins; the jobs on a store."""

import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF
from vigil import schemas as SCH
from vigil.catalog_store import bucketed_store
from vigil.operators import iforest as IF
from vigil.operators import reports as RP
from vigil.operators import rules as R
from vigil.plans import jobs as J
from vigil.session import scratch_dir
from vigil.sources import csv as CSV
from vigil.sources import ids as ID
from vigil.sources.buckets import write_bucketed
from vigil.sources.store import Store
from vigil.sources.views import table

def fault():
    return F.raise_error(F.lit("a planted fault"))


@pytest.fixture
def store(spark):
    return Store(spark, scratch_dir(spark, "store"))


def values(df):
    return sorted(r[0] for r in df.collect())


def test_refresh_from_itself(spark, store):
    store.refresh({"t": spark.range(10)})
    store.refresh({"t": store.read("t").where("id > 3")})
    store.refresh({"t": store.read("t").select((F.col("id") * 2).alias("id"))})
    assert values(store.read("t")) == [8, 10, 12, 14, 16, 18] and store.versions() == [1, 2, 3]
    assert values(store.read("t", version=1)) == list(range(10))


def test_a_failed_refresh_changes_nothing(spark, store):
    store.refresh({"t": spark.range(10), "u": spark.range(3)})
    early = store.read("t")
    half = spark.range(0, 1000, numPartitions=4).select(F.when(F.col("id") == 999, fault().cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        store.refresh({"u": spark.range(7), "t": half})   # u is written before t fails
    assert store.versions() == [1] and values(store.read("t")) == list(range(10)) and store.read("u").count() == 3
    store.refresh({"t": spark.range(2)})
    assert early.count() == 10 and store.read("t").count() == 2   # who read before still reads the old version


def test_tables_change_together_and_writers_do_not_lose_each_other(spark, store):
    store.refresh({"a": spark.range(1), "b": spark.range(2)})
    other = Store(spark, store.root)
    seen = []
    manifest = store.manifest

    def raced(version=None):   # another writer commits between this one's look and its commit
        found = manifest(version)
        if not seen:
            seen.append(1)
            other.refresh({"b": spark.range(20)})
        return found
    store.manifest = raced
    store.refresh({"a": spark.range(10)})
    store.manifest = manifest
    assert store.read("a").count() == 10 and store.read("b").count() == 20 and store.versions() == [1, 2, 3]


def test_appends_by_run(spark, store):
    row = spark.range(1)
    assert store.append("h", row, "r1") == 1 and store.append("h", row, "r2") == 2
    assert store.append("h", row, "r1") == 2 and store.append("h", row, "r2") == 2
    store.append("h", row)
    assert store.read("h").count() == 3
    store.refresh({"h": store.read("h").limit(1)})
    store.append("h", row, "r1")    # a refresh begins anew
    assert store.read("h").count() == 2


def test_expire_deletes_what_no_kept_version_names(spark, store):
    for n in (1, 2, 3):
        store.refresh({"t": spark.range(n)})
    store.append("t", spark.range(4))
    gone = store.expire(keep=1)
    assert len(gone) == 2 and store.versions() == [4] and store.read("t").count() == 7
    assert len(glob.glob(f"{store.root}/t/*")) == 2


def test_definitions_and_unknown_tables(spark):
    store = Store(spark, scratch_dir(spark, "store"), SCH.store_schemas(3))
    assert not store.has("anomalies")
    with pytest.raises(KeyError):
        store.read("anomalies")
    store.define()
    assert store.define() == 1 and store.read("anomalies").count() == 0 and store.read("anomalies").schema == SCH.ANOMALIES
    store.append("anomalies", spark.createDataFrame([(1, 2, 0.5, "m", 9)], "id int, transaction_id int, anomaly_score float, detection_method string, more int"))
    assert store.read("anomalies", ["anomaly_score"]).dtypes == [("anomaly_score", "double")]


def test_broken_lines_are_quarantined(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v,t\n1,1.5,x\n2,abc,y\n3,2.5\n4,3.5,z,more\n,,\n5,NaN,"q,r"\n')
    (tmp_path / "b.csv").write_text("k,v,t\n6,1e400,\n9223372036854775808,1,x\n")
    schema = SCH.T._parse_datatype_string("k long, v double, t string")
    load = CSV.load_checked(spark, str(tmp_path), schema)
    assert [(r.line_id, r.source_file.rsplit("/")[-1], r.line) for r in load.quarantine.orderBy("line_id").collect()] == [
        (2, "a.csv", "2,abc,y"), (3, "a.csv", "3,2.5"), (4, "a.csv", "4,3.5,z,more"), (8, "b.csv", "9223372036854775808,1,x")]
    assert [(r.transaction_id, r.k, r.t) for r in load.rows.orderBy("transaction_id").collect()] == [(1, 1, "x"), (5, None, None), (6, 5, "q,r"), (7, 6, None)]
    assert load.counts.first().asDict() == {"lines": 8, "loaded": 4, "quarantined": 4}


def test_an_empty_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n")
    load = CSV.load_checked(spark, str(tmp_path), SCH.T._parse_datatype_string("k long, v double"))
    assert load.rows.count() == 0 and load.quarantine.count() == 0 and load.counts.first()["lines"] == 0


@pytest.mark.parametrize("most", [10**6, 0])
def test_ids_follow_files_blocks_and_lines(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(ID, "BROADCAST_BLOCKS", most)
    for i, name in enumerate("cab"):
        (tmp_path / f"{name}.csv").write_text("".join(f"{i * 1000 + j}\n" for j in range(200 * i + 50)))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
        path = scratch_dir(spark, "numbered")
        ID.with_source(spark.read.schema("x long").csv(str(tmp_path))).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    got = [r["x"] for r in ID.with_line_id(spark.read.parquet(path), "id").orderBy("id").collect()]
    assert got == [*range(1000, 1250), *range(2000, 2450), *range(0, 50)]


def joined_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_joins_exchange_nothing(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as for tables too large to broadcast
    try:
        t = bucketed_store(spark, SF, "transactions", "results", "outliers")
        small = write_bucketed(table(spark, SF, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "orders", 8, "l_orderkey")
        lines = write_bucketed(table(spark, SF, "lineitem").select("l_orderkey", "l_linenumber"), "lines", 8, "l_orderkey")
        for df in (R.failures(t["results"]).join(t["transactions"], "transaction_id", "left"),
                   t["transactions"].join(t["outliers"], "transaction_id", "left"),
                   t["outliers"].join(t["transactions"].where("class = 1"), "transaction_id"),
                   RP.orphans(t["outliers"], t["transactions"].where("class = 0")),
                   RP.orphans(t["results"], t["transactions"].where("amount >= 50")), RP.orphans(lines, small, "l_orderkey")):
            plan = joined_plan(df)
            assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_bucketed_tables_hold_their_rows(spark):
    rows = spark.range(1000).select(F.col("id").alias("transaction_id"), (F.col("id") % 7).alias("x"))
    got = write_bucketed(rows, "plain", 5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    assert write_bucketed(rows.limit(0), "nothing", 5).count() == 0


def test_a_job_that_fails_leaves_the_store_as_it_was(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Time,V1,Amount,Class\n" + "".join(f"{i},{i % 5},{i}.5,{i % 2}\n" for i in range(50)) + "x,1,2,0\n1,2\n")
    root = scratch_dir(spark, "jobs")
    small = IF.ForestParams(trees=5, sample_size=16)
    J.run_all(spark, str(tmp_path), root, scratch_dir(spark, "out"), 1, "2024-06-30", ["amount", "v1"], small, run_id="a", run_at="2024-06-30 08:00:00")
    store = J.open_store(spark, root, 1)
    before = store.versions()
    assert store.read("load_counts").first().asDict() == {"lines": 52, "loaded": 50, "quarantined": 2}
    assert [r.line for r in store.read("quarantine").orderBy("line_id").collect()] == ["x,1,2,0", "1,2"]
    bad = CSV.load_card_csv(spark, str(tmp_path), 1)
    bad.rows = bad.rows.withColumn("v1", F.when(F.col("transaction_id") == 50, fault().cast("double")).otherwise(F.col("v1")))
    with pytest.raises(PySparkException):
        J.validate(spark, bad, root, n_features=1)
    assert store.versions() == before and store.read("raw_transactions").count() == 50
    # A repeated run adds no score; a later run of the same day is the latest.
    J.score(spark, root, "2024-06-30", "a", "2024-06-30 08:00:00")
    assert store.read("data_quality_history").count() == 1
    store.refresh({"validation_results": store.read("validation_results").where("transaction_id < 40 OR rule_passed")})
    J.score(spark, root, "2024-06-30", "b", "2024-06-30 09:00:00")
    J.score(spark, root, "2024-06-30", "c", "2024-06-30 07:00:00")
    runs = [r.run_id for r in RP.history_ordered(store.read("data_quality_history")).collect()]
    assert runs == ["c", "a", "b"]
    latest = RP.latest_score(store.read("data_quality_history")).first()["quality_score"]
    assert latest == store.read("data_quality_history").where("run_id = 'b'").first()["quality_score"]


def test_numberings_are_compared_in_parts_of_bounded_rows(spark, monkeypatch):
    from vigil import catalog_store as CS
    path = scratch_dir(spark, "sf")
    spark.range(6000).selectExpr("id DIV 4 AS l_orderkey").write.parquet(f"{path}/lineitem.parquet")
    monkeypatch.setattr(CS, "ROWS_OF_A_PART", 500)
    got = CS.s2_ids_over_files(spark, path)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 12), REPARTITION_BY_NUM") == 3  # both numberings by file and place, then the ids
    assert [tuple(r) for r in got.collect()] == [(6000, 1, 6000, 6000, 0, 0)]
