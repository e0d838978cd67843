"""Physical plan shapes that matter at scale."""

from conftest import SF
import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_before_join(spark):
    from vigil.operators import detect as DT
    from vigil.operators import reports as RP
    from vigil.sources.views import view
    d = DT.detect(view(spark, SF, "tx_events"), ["amount"], scale=False)
    df = RP.top_anomalies(DT.anomalies(d), view(spark, SF, "tx_events"), 200)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the k-row side is cut before the join and broadcast to it
    assert "TakeOrderedAndProject" in plan or "Limit" in plan
    assert "Broadcast" in plan


def test_pruned_scan_and_pushdown(spark):
    from pyspark.sql import functions as F
    from vigil.sources.views import table
    li = table(spark, SF, "lineitem").where(F.col("l_quantity") > 10).select("l_orderkey")
    plan = _plan(li)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_fused_summary_single_exchange(spark):
    plan = _plan(E.queries()["a1_validation_summary"](spark, SF))
    # one partial + final aggregate of a single row; the sort of 5 rows adds one more exchange at most
    assert plan.count("Exchange") <= 2
    # rules are summed wide; the only Generate stacks the one aggregated row (above the aggregate)
    assert plan.index("Generate") < plan.index("HashAggregate")


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_checks"] == 5 * rows[0]["total_records"]


def test_grow_partitions_not_coalesced(spark):
    from pyspark.sql import functions as F
    from vigil.operators import iforest as IF
    training = spark.range(0, 640).select((F.col("id") % 10).cast("int").alias("tree"), F.col("id").alias("_id"),
                                          (F.col("id") * 0.5).alias("x"))
    nodes = IF.grow(training, ["x"], 64, 42, trees=10)
    plan = _plan(nodes)
    want = min(10, spark.sparkContext.defaultParallelism)
    assert f"hashpartitioning(tree#" in plan and f", {want}), REPARTITION_BY_NUM" in plan
    assert plan.count("Exchange") == 1                  # the grouping reuses the explicit partitioning
    assert nodes.select("tree").distinct().count() == 10


def test_cut_reads_one_column_of_scored_table(spark):
    from pyspark.sql import functions as F
    from vigil.operators import detect as DT
    from vigil.sources.views import view
    d = DT.detect(view(spark, SF, "tx_events"), ["amount", "v1"])
    plan = _plan(d.scored.where(F.col("path_units").isNotNull()).select("path_units"))
    assert "FileScan parquet" in plan and "ReadSchema: struct<path_units:bigint>" in plan


def test_detector_stages_its_input_only_when_asked(spark):
    from vigil.operators import detect as DT
    from vigil.sources.views import view
    df = view(spark, SF, "tx_orders")
    det = DT.detect(df, ["amount", "v1"], stage_partitions=4, carry=["region"])
    assert "Join" not in _plan(det.source) and "FileScan parquet" in _plan(det.source)   # the view's joins ran once
    assert det.source.columns == ["transaction_id", "amount", "v1", "region"]
    assert det.source.count() == df.count()
    assert DT.detect(df, ["amount", "v1"]).source is df
