"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) as Spark jobs.

* Survey: one pass over the rows gives their number, the moments of the
  features, and of every partition the `trees * sample_size` rows with the
  lowest md5 draws of (seed, row). Both merge, so the pass is the only one
  before scoring, and any engine can rebuild the choice of rows.
* Sample: psi = min(sample_size, n) rows per tree. The trees * psi places are
  dealt round over the rows with the lowest draws, so trees share rows only
  where the table is too small for disjoint ones.
* Grow: `groupBy("tree").applyInPandas`, one task per tree on psi rows.
  Feature and split come from md5 draws of (seed, tree, node). The result
  is a node table with at most trees * (2 psi - 1) rows.
* Score: that bounded node table is broadcast and every row is scored in
  Arrow batches by a pandas UDF (narrow, no shuffle). The path length sum
  over trees is kept as an integer (units of 1e-9) so sums and cuts are
  exact and independent of summation order.
* Cut: the `contamination` share of rows with the shortest paths is
  flagged; the cut is an exact order statistic of the integer sums.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vigil.functions.draws import TWO_32, md5_hex, py_uniform
from vigil.session import scratch_dir

EULER_GAMMA = 0.5772156649015329
UNITS = 1e9                    # path length fixed point: 1e-9


@dataclass(frozen=True)
class ForestParams:
    trees: int = 100
    sample_size: int = 256
    seed: int = 42
    contamination: float = 0.02


def c_factor(m: float) -> float:
    """Average path length of an unsuccessful BST search over m points."""
    if m > 2:
        return 2.0 * (math.log(m - 1) + EULER_GAMMA) - 2.0 * (m - 1) / m
    if m == 2:
        return 1.0
    return 0.0


def max_depth(psi: int) -> int:
    return int(math.ceil(math.log2(psi))) if psi > 1 else 0


def leaf_units(depth: int, size: int) -> int:
    return int(math.floor((depth + c_factor(size)) * UNITS + 0.5))


NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType(), False),
    T.StructField("node", T.IntegerType(), False),
    T.StructField("depth", T.IntegerType(), False),
    T.StructField("size", T.LongType(), False),
    T.StructField("is_leaf", T.BooleanType(), False),
    T.StructField("feature", T.IntegerType(), True),
    T.StructField("split", T.DoubleType(), True),
    T.StructField("units", T.LongType(), True),
])


# ------------------------------------------------------------------ sample
HASH_LEVELS = 32   # thresholds 2**-1 .. 2**-32 of the row draw

SURVEY = "_h binary, _id string, x array<double>, n long, mean array<double>, m2 array<double>"


class _Lowest:
    """The rows with the lowest hashes of a partition, at most `most` of them, and the moments of all its rows."""

    def __init__(self, most: int, width: int):
        self.most, self.n = most, 0
        self.mean, self.m2 = np.zeros(width), np.zeros(width)
        self.hash, self.x, self.ids = np.zeros((0, 2), np.uint64), np.zeros((0, width)), pa.array([], pa.string())

    def add(self, hashes: np.ndarray, x: np.ndarray, ids) -> None:
        m = len(x)
        if not m:
            return
        mean = x.mean(axis=0)
        away = mean - self.mean
        self.m2 += ((x - mean) ** 2).sum(axis=0) + away ** 2 * (self.n * m / (self.n + m))
        self.mean += away * (m / (self.n + m))
        self.n += m
        if len(self.hash) >= self.most:  # only what can still be among the lowest
            near = np.flatnonzero(hashes[:, 0] <= self.hash[:, 0].max())
            hashes, x, ids = hashes[near], x[near], ids.take(pa.array(near))
        self.hash, self.x = np.concatenate([self.hash, hashes]), np.concatenate([self.x, x])
        self.ids = pa.concat_arrays([self.ids, ids])
        if len(self.hash) > self.most:
            keep = np.lexsort((self.hash[:, 1], self.hash[:, 0]))[:self.most]
            self.hash, self.x, self.ids = self.hash[keep], self.x[keep], self.ids.take(pa.array(keep))

    def rows(self):
        """The candidates, and one row of moments."""
        names, own, numbers = [c.split()[0] for c in SURVEY.split(", ")], len(self.hash), pa.list_(pa.float64())
        keys = pa.Array.from_buffers(pa.binary(16), own, [None, pa.py_buffer(self.hash.astype(">u8").tobytes())]).cast(pa.binary())
        width = self.x.shape[1]
        values = pa.ListArray.from_arrays(pa.array(np.arange(own + 1, dtype=np.int32) * width), pa.array(self.x.ravel()))
        yield pa.RecordBatch.from_arrays([keys, self.ids, values, pa.nulls(own, pa.int64()), pa.nulls(own, numbers), pa.nulls(own, numbers)], names=names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), pa.nulls(1, pa.string()), pa.nulls(1, numbers), pa.array([self.n], pa.int64()),
                                          *[pa.array([v.tolist()], numbers) for v in (self.mean, self.m2)]], names=names)


@dataclass
class Survey:
    """What the first pass finds: rows, means and population deviations by feature, and the candidates of the sample."""
    features: list[str]
    n: int
    mean: dict[str, float]
    std: dict[str, float]
    candidates: DataFrame   # _h, _id, x, _level
    under: list[int]        # of the candidates, how many have a draw under 2**-j, j from 0


def survey(df: DataFrame, id_col: str, features: list[str], p: ForestParams) -> Survey:
    """One pass over the complete rows with finite features.

    Every partition hands on at most trees * sample_size rows (`_Lowest`),
    whatever its size, and one row of moments.
    """
    xs = [F.col(c).cast("double") for c in features]
    rows = df.select(F.unhex(md5_hex(p.seed, F.col(id_col))).alias("_h"), F.col(id_col).cast("string").alias("_id"), *[x.alias(f"x{i}") for i, x in enumerate(xs)])
    for i in range(len(xs)):
        rows = rows.where(F.abs(f"x{i}") < F.lit(math.inf))  # no null and no NaN either: NaN is the largest
    most, width = p.trees * p.sample_size, len(features)

    def run(batches):
        lowest = _Lowest(most, width)
        for batch in batches:
            raw = batch.column("_h").cast(pa.binary(16))
            hashes = np.frombuffer(raw.buffers()[1], ">u8", 2 * len(raw), 16 * raw.offset).reshape(-1, 2).astype(np.uint64)
            x = np.stack([batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(width)], axis=1) if width else np.zeros((len(raw), 0))
            lowest.add(hashes, x, batch.column("_id"))
        yield from lowest.rows()

    spark = df.sparkSession
    path = scratch_dir(spark, "survey")
    rows.mapInArrow(run, SURVEY).write.parquet(path)
    found = spark.read.parquet(path)
    u = F.conv(F.hex(F.substring("_h", 1, 4)), 16, 10).cast("double") / F.lit(TWO_32)
    level = F.when(u > 0, F.least(F.floor(-F.log2(u)), F.lit(HASH_LEVELS))).when(F.col("_h").isNotNull(), HASH_LEVELS).cast("int")
    found = found.withColumn("_level", level)
    moments = found.where("n > 0")
    at = lambda c, i: F.element_at(c, i + 1)
    # Rows of candidates have no moments, rows of moments no level: one aggregate for both.
    first = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.sum(F.when(F.col("n") > 0, F.col("n") * at("mean", i))).alias(f"s{i}") for i in range(width)],
                      *[F.count_if(F.col("_level") >= j).alias(f"l{j}") for j in range(HASH_LEVELS + 1)]).first()
    n = first["n"]
    mean = [first[f"s{i}"] / n if n else 0.0 for i in range(width)]
    spread = moments.agg(*[F.sum(at("m2", i) + F.col("n") * F.pow(at("mean", i) - F.lit(mean[i]), F.lit(2.0))).alias(f"q{i}") for i in range(width)]).first()
    std = [math.sqrt(max(spread[f"q{i}"], 0.0) / n) if n else 0.0 for i in range(width)]
    return Survey(features, n, dict(zip(features, mean)), dict(zip(features, std)), found.where("_h IS NOT NULL").select("_h", "_id", "x", "_level"),
                  [first[f"l{j}"] for j in range(HASH_LEVELS + 1)])


def sample(found: Survey, p: ForestParams, scale: bool = False) -> tuple[DataFrame, int]:
    """Training rows (tree, _id, features...) and psi.

    The m = min(n, trees * psi) rows with the lowest hashes are dealt round:
    place i of trees * psi takes the row of rank i mod m and belongs to tree
    i div psi. So a tree has psi different rows. With `scale` the features
    are standardised.
    """
    if found.n == 0:
        raise ValueError("no complete rows to train on")
    psi = min(p.sample_size, found.n)
    k = p.trees * psi
    m = min(found.n, k)
    # The m lowest are among the candidates; those under the lowest power of two that m of them are under include them.
    lowest = max(j for j, n in enumerate(found.under) if n >= m)
    top = found.candidates.where(F.col("_level") >= lowest).orderBy("_h", "_id").limit(m)
    # Window and explode run over the m gathered rows only and make trees * psi rows.
    rk = (F.row_number().over(Window.orderBy("_h", "_id")) - 1).cast("long")
    places = F.sequence(F.col("_rk"), F.lit(k - 1).cast("long"), F.lit(m).cast("long"))
    s = top.withColumn("_rk", rk).withColumn("_place", F.explode(places)).withColumn("tree", F.expr(f"_place div {psi}"))
    x = [F.element_at("x", i + 1) for i in range(len(found.features))]
    if scale:
        x = [(v - F.lit(found.mean[c])) / F.lit(found.std[c] or 1.0) for v, c in zip(x, found.features)]
    return s.select(F.col("tree").cast("int"), "_id", *[v.alias(c) for v, c in zip(x, found.features)]), psi


# -------------------------------------------------------------------- grow
def _grow_one(X: np.ndarray, tree: int, psi: int, seed: int) -> list[tuple]:
    limit = max_depth(psi)
    rows = []
    stack = [(1, 0, np.arange(len(X)))]
    while stack:
        node, depth, idx = stack.pop()
        size = len(idx)
        split_on = None
        if depth < limit and size > 1:
            sub = X[idx]
            mn, mx = sub.min(axis=0), sub.max(axis=0)
            varying = np.nonzero(mx > mn)[0]
            if len(varying):
                j = int(varying[int(math.floor(py_uniform(seed, tree, node, "f") * len(varying)))])
                split = float(mn[j] + py_uniform(seed, tree, node, "s") * (mx[j] - mn[j]))
                split_on = (j, split, sub[:, j])
        if split_on is None:
            rows.append((tree, node, depth, size, True, None, None, leaf_units(depth, size)))
            continue
        j, split, col = split_on
        rows.append((tree, node, depth, size, False, j, split, None))
        go_right = col >= split
        stack.append((2 * node + 1, depth + 1, idx[go_right]))
        stack.append((2 * node, depth + 1, idx[~go_right]))
    return rows


def grow(training: DataFrame, features: list[str], psi: int, seed: int, trees: int | None = None) -> DataFrame:
    """Node table, one applyInPandas group per tree.

    With `trees` given, the training rows are hash-partitioned into
    min(trees, cores) partitions first: the input is tiny (trees * psi rows)
    but each group is CPU work, and an explicit partition count is not
    coalesced by AQE into a single task. On a cluster with more cores than
    trees that is one tree per task. The grouping reuses this partitioning
    (no second exchange).
    """

    def per_tree(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        X = pdf[features].to_numpy(dtype="float64")
        nodes = _grow_one(X, tree, psi, seed)
        out = pd.DataFrame(nodes, columns=NODE_SCHEMA.fieldNames())
        for c in ("feature", "units"):
            out[c] = out[c].astype("Int64")
        return out

    if trees:
        cores = training.sparkSession.sparkContext.defaultParallelism
        training = training.repartition(max(1, min(trees, cores)), "tree")
    return training.groupBy("tree").applyInPandas(per_tree, schema=NODE_SCHEMA)


# ------------------------------------------------------------------- score
@dataclass
class Forest:
    features: list[str]
    trees: int
    psi: int
    n_train_rows: int
    depth: int
    feature: np.ndarray   # [trees, slots] int
    split: np.ndarray     # [trees, slots] float
    leaf: np.ndarray      # [trees, slots] bool
    units: np.ndarray     # [trees, slots] int64
    nodes: DataFrame

    @property
    def c_psi(self) -> float:
        return c_factor(self.psi)


def fit(found: Survey, p: ForestParams = ForestParams(), scale: bool = False) -> Forest:
    """The forest grown on the sample of a survey; with `scale`, over standardised features."""
    features, n = found.features, found.n
    training, psi = sample(found, p, scale)
    nodes = grow(training, features, psi, p.seed, p.trees)
    rows = nodes.collect()   # bounded: at most trees * (2 psi - 1) rows
    depth = max_depth(psi)
    slots = 2 ** (depth + 1)
    feat = np.zeros((p.trees, slots), dtype=np.int64)
    split = np.zeros((p.trees, slots), dtype=np.float64)
    leaf = np.ones((p.trees, slots), dtype=bool)
    units = np.zeros((p.trees, slots), dtype=np.int64)
    for r in rows:
        t, nd = r["tree"], r["node"]
        leaf[t, nd] = r["is_leaf"]
        if r["is_leaf"]:
            units[t, nd] = r["units"]
        else:
            feat[t, nd], split[t, nd] = r["feature"], r["split"]
    spark = training.sparkSession
    node_df = spark.createDataFrame([tuple(r) for r in rows], NODE_SCHEMA) if rows else nodes
    return Forest(features, p.trees, psi, n, depth, feat, split, leaf, units, node_df)


def path_units(forest: Forest, columns: list[str] | None = None):
    """pandas UDF over `columns` (default: the features): integer sum over trees of path lengths (units 1e-9); NULL if one is missing."""
    spark_ctx = forest.nodes.sparkSession.sparkContext
    bc = spark_ctx.broadcast((forest.feature, forest.split, forest.leaf, forest.units, forest.depth))

    @F.pandas_udf(T.LongType())
    def score(*cols: pd.Series) -> pd.Series:
        feat, split, leaf, units, depth = bc.value
        X = np.column_stack([c.to_numpy(dtype="float64", na_value=np.nan) for c in cols])
        ok = ~np.isnan(X).any(axis=1)
        Xo = X[ok]
        n = len(Xo)
        total = np.zeros(n, dtype=np.int64)
        rows = np.arange(n)
        for t in range(feat.shape[0]):
            node = np.ones(n, dtype=np.int64)
            for _ in range(depth + 1):
                inner = ~leaf[t, node]
                if not inner.any():
                    break
                x = Xo[rows, feat[t, node]]
                step = 2 * node + (x >= split[t, node])
                node = np.where(inner, step, node)
            total += units[t, node]
        out = pd.Series(pd.array([None] * len(X), dtype="Int64"))
        out[ok] = total
        return out

    return score(*[F.col(c).cast("double") for c in columns or forest.features])


def raw_score(units_col, forest: Forest):
    """score_samples: -2 ** (-mean path length / c(psi))."""
    mean_h = units_col.cast("double") / F.lit(UNITS * forest.trees)
    return -F.pow(F.lit(2.0), -mean_h / F.lit(forest.c_psi))


def score(df: DataFrame, forest: Forest, columns: list[str] | None = None) -> DataFrame:
    """Adds `path_units` (long) and `raw_score` (double) to every row."""
    out = df.withColumn("path_units", path_units(forest, columns))
    return out.withColumn("raw_score", raw_score(F.col("path_units"), forest))


# --------------------------------------------------------------------- cut
def cut_rank(n: int, contamination: float) -> tuple[int, float]:
    pos = contamination * (n - 1)
    i = int(math.floor(pos))
    return i, pos - i


def sql_c_factor(m: str) -> str:
    return (f"(CASE WHEN {m} > 2 THEN 2.0 * (ln({m} - 1) + {EULER_GAMMA}) - 2.0 * ({m} - 1) / {m} "
            f"WHEN {m} = 2 THEN 1.0 ELSE 0.0 END)")
