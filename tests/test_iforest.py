"""Forest invariants, both sampling regimes against the SQL rebuild,
partition independence, and planted outliers."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF
from vigil.forest_sql import cut_ctes, forest_ctes, with_ctes
from vigil.operators import detect as DT
from vigil.operators import iforest as IF
from vigil.sources.views import VIEW_SQL, view

SMALL = IF.ForestParams(trees=10, sample_size=64, seed=7, contamination=0.05)


def _sql_for(view_name, feats, p):
    complete = " AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in feats)
    ctes = [(view_name, VIEW_SQL[view_name]),
            ("f_src", f"SELECT transaction_id AS _id, {', '.join(feats)} FROM {view_name} WHERE {complete}")]
    return ctes + forest_ctes("f_src", feats, p) + cut_ctes(p.contamination)


@pytest.mark.parametrize("params", [SMALL, IF.ForestParams(trees=20, sample_size=256, seed=3, contamination=0.1)])
def test_sampling_regimes_match_sql(spark, duck, params):
    # tx_acct has 1,500 rows: with trees*psi = 640 the trees are disjoint,
    # with 20*256 = 5,120 they share rows.
    feats = ["amount", "v1"]
    d = DT.detect(view(spark, SF, "tx_acct"), feats, params=params, scale=False)
    ctes = _sql_for("tx_acct", feats, params)
    sql_nodes = duck.execute(with_ctes(ctes, "SELECT tree, node, size, is_leaf, feature, split, units FROM f_nodes")).fetchall()
    sp_nodes = [(r["tree"], r["node"], r["size"], r["is_leaf"], r["feature"], r["split"], r["units"])
                for r in d.forest.nodes.collect()]
    assert sorted(sp_nodes, key=str) == sorted(sql_nodes, key=str)
    flagged_sql = {r[0] for r in duck.execute(with_ctes(ctes, "SELECT _id FROM f_scores, f_cut WHERE path_units < t_units")).fetchall()}
    flagged_sp = {r["transaction_id"] for r in d.scored.where("flagged").collect()}
    assert flagged_sp == flagged_sql
    assert len(flagged_sp) == d.scored.where("flagged").count()


def test_tree_invariants(spark):
    d = DT.detect(view(spark, SF, "tx_events"), ["amount", "v1", "v2", "v3"])
    f = d.forest
    assert f.psi == 256 and f.depth == 8
    per_tree = f.nodes.groupBy("tree").agg(F.count("*").alias("n"), F.max("depth").alias("d"),
                                          F.sum(F.when(F.col("is_leaf"), F.col("size")).otherwise(0)).alias("leaf_rows")).collect()
    assert len(per_tree) == 100
    for r in per_tree:
        assert r["n"] <= 2 * 256 - 1 and r["d"] <= 8 and r["leaf_rows"] == 256
    # Flagged count follows the cut rank exactly (no ties at the threshold here).
    n = d.n
    i, frac = IF.cut_rank(n, 0.02)
    assert d.scored.where("flagged").count() == i + (1 if frac > 0 else 0)
    assert d.scored.where("flagged AND decision >= 0").count() == 0


def test_partition_independence(spark):
    base = view(spark, SF, "tx_acct")
    feats = ["amount", "v1"]
    ref = None
    for parts in (1, 4, 17):
        d = DT.detect(base.repartition(parts), feats, params=SMALL)
        got = sorted((r["transaction_id"], r["path_units"]) for r in d.scored.select("transaction_id", "path_units").collect())
        ref = ref or got
        assert got == ref


def test_planted_extreme_and_missing(spark):
    rows = [(i, float(i % 50), float((i * 7) % 13), 3.0) for i in range(1, 2001)]
    rows.append((5000, 1e6, 1e6, 3.0))        # planted extreme
    rows.append((5001, None, 1.0, 3.0))       # missing feature: no score, never flagged
    df = spark.createDataFrame(rows, "transaction_id long, a double, b double, c double")
    d = DT.detect(df, ["a", "b", "c"], params=IF.ForestParams(trees=50, sample_size=128, seed=1, contamination=0.01))
    lowest = d.scored.where(F.col("path_units").isNotNull()).orderBy("raw_score", "transaction_id").first()
    assert lowest["transaction_id"] == 5000
    miss = d.scored.where("transaction_id = 5001").first()
    assert miss["path_units"] is None and miss["flagged"] is False
    # The constant feature c (index 2) is never split on.
    assert d.forest.nodes.where("feature = 2").count() == 0


def test_c_factor():
    assert IF.c_factor(0) == 0 and IF.c_factor(1) == 0 and IF.c_factor(2) == 1
    assert math.isclose(IF.c_factor(256), 2 * (math.log(255) + IF.EULER_GAMMA) - 2 * 255 / 256)


def test_sweep_monotone(spark):
    d = DT.detect(view(spark, SF, "tx_events"), ["amount"], scale=False)
    s = [r["anomalies_found"] for r in DT.sweep(d).orderBy("contamination").collect()]
    assert s == sorted(s) and s[0] > 0


def test_known_count_matches_counted(spark):
    # The cut's row count is taken from the statistics pass; it must equal the scored rows.
    from vigil.operators import detect as DT
    from vigil.sources.views import view
    df = view(spark, SF, "tx_events")
    d = DT.detect(df, ["amount", "v1"])
    assert d.n == d.scored.where("path_units IS NOT NULL").count()
    inf = spark.createDataFrame([(1, 1.0), (2, float("inf")), (3, 2.0), (4, 3.0)], "transaction_id long, amount double")
    d2 = DT.detect(inf, ["amount"], params=IF.ForestParams(trees=3, sample_size=4))
    assert d2.n == d2.scored.where("path_units IS NOT NULL").count()


def test_one_infinite_value_does_not_silence_the_detector(spark):
    import math
    from vigil.operators import detect as DT
    from vigil.operators import iforest as IF
    rows = [(i, math.inf if i == 7 else float(i % 50), float(i % 13)) for i in range(400)]
    df = spark.createDataFrame(rows, "transaction_id long, amount double, v1 double")
    det = DT.detect(df, ["amount", "v1"], params=IF.ForestParams(trees=5, contamination=0.05))
    assert det.scored.where("flagged").count() > 0
    assert det.scored.where("path_units IS NULL").select("transaction_id").collect() == [(7,)]
