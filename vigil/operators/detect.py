"""Outlier detection jobs on top of the forest: scale, fit, score, cut,
flag, and the evaluation figures (metrics against labels, contamination
sweep, flagged share).

The scored frame is written as a Parquet table under the shared checkpoint
folder: it feeds the cut (order statistics) and every report, recomputing
the UDF pass per consumer would repeat the most expensive stage, and a
columnar copy lets the cut read one column instead of whole rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators import iforest as IF
from vigil.operators.profile import neighbours_many
from vigil.operators.scaling import apply_scaler
from vigil.session import scratch_dir

METHOD = "IsolationForest"


@dataclass
class Detection:
    scored: DataFrame        # input columns + path_units, raw_score, decision, flagged
    forest: IF.Forest
    t_units: int | None
    cut_raw: float | None
    n: int
    contamination: float
    method: str
    source: DataFrame        # the input rows as read (the staged copy where one was asked for)


def _raw_from_units(units: int, forest: IF.Forest) -> float:
    return -(2.0 ** (-(units / (IF.UNITS * forest.trees)) / forest.c_psi))


def cut_for(scored: DataFrame, forest: IF.Forest, rates: list[float]):
    """Per rate (t_units, cut_raw), and the number of rows with a score. Two scans of one column for all rates."""
    n, around = neighbours_many(scored, ["path_units"], list(rates))["path_units"]
    if n == 0:
        return [(None, None) for _ in rates], 0
    out = []
    for lo, hi, frac in around:
        lo, hi = int(lo), int(hi)
        t = hi if frac > 0 else lo
        rlo, rhi = _raw_from_units(lo, forest), _raw_from_units(hi, forest)
        out.append((t, rlo + (rhi - rlo) * frac))
    return out, n


def staged(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """`df` written once under the checkpoint folder, hash-spread by `key` over `partitions`.

    For an input that is costly to compute (joins) or lies in few partitions:
    the detector reads it twice (survey, score).
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "input")
    df.repartition(partitions, key).write.parquet(path)
    return spark.read.parquet(path)


def detect(df: DataFrame, features: list[str], id_col: str = "transaction_id",
           params: IF.ForestParams = IF.ForestParams(), scale: bool = True, method: str = METHOD,
           checkpoint: bool = True, stage_partitions: int | None = None, carry: list[str] | None = None) -> Detection:
    """Fit on a hash sample, score every row, flag the `contamination` share.

    `carry` names the columns kept beside the id and the features (None: all).
    With `stage_partitions` the input is computed once and read from a copy
    (see `staged`); otherwise it is read as it is.

    Rows with a missing or infinite feature get NULL scores and are never flagged.
    """
    zcols = [f"z_{c}" for c in features]
    if carry is not None:
        df = df.select(*dict.fromkeys([id_col, *features, *carry]))
    if stage_partitions:
        df = staged(df, id_col, stage_partitions)
    # An infinite feature has no place on a scale: it counts as missing.
    finite = {c: F.when(F.abs(F.col(c).cast("double")) < F.lit(math.inf), F.col(c).cast("double")) for c in features}
    found = IF.survey(df, id_col, features, params)
    forest = IF.fit(found, params, scale)
    prepared = df.select("*", *[finite[c].alias(z) for c, z in zip(features, zcols)])
    if scale:
        prepared = apply_scaler(prepared, {z: (found.mean[c], found.std[c] or 1.0) for c, z in zip(features, zcols)})
    scored = IF.score(prepared, forest, zcols).drop(*zcols)
    if checkpoint:
        spark = df.sparkSession
        path = scratch_dir(spark, "scored")
        scored.write.parquet(path)
        scored = spark.read.parquet(path)
    (t_units, cut_raw), n = (lambda r: (r[0][0], r[1]))(cut_for(scored, forest, [params.contamination]))
    scored = scored.withColumn("decision", F.col("raw_score") - F.lit(cut_raw).cast("double")) \
                   .withColumn("flagged", F.coalesce(F.col("path_units") < F.lit(t_units), F.lit(False)))
    return Detection(scored, forest, t_units, cut_raw, n, params.contamination, method, df)


def anomalies(det: Detection, id_col: str = "transaction_id", method_index: int = 0, digits: int = 6) -> DataFrame:
    """Stored outlier rows: (id, transaction_id, anomaly_score, detection_method).

    Scores are rounded after the cut. `id` = transaction_id * 16 + method_index
    keeps one key per (row, detector) without a global numbering pass.
    """
    return det.scored.where(F.col("flagged")).select(
        (F.col(id_col) * 16 + method_index).cast("long").alias("id"),
        F.col(id_col).cast("long").alias("transaction_id"),
        F.round(F.col("decision"), digits).alias("anomaly_score"),
        F.lit(det.method).alias("detection_method"),
    )


def metrics(det: Detection, label_col: str = "class") -> DataFrame:
    """Flagged vs labels: counts, recall (caught / max(total, 1)), precision, F1, in percent."""
    s = det.scored
    flagged, pos = F.col("flagged"), F.coalesce(F.col(label_col) == 1, F.lit(False))
    one = s.agg(F.count_if(flagged).cast("long").alias("anomalies"),
                F.count_if(pos).cast("long").alias("total_frauds"),
                F.count_if(flagged & pos).cast("long").alias("frauds_caught"),
                F.count(F.lit(1)).cast("long").alias("total_rows"))
    rec = F.col("frauds_caught") / F.greatest(F.col("total_frauds"), F.lit(1))
    prec = F.col("frauds_caught") / F.greatest(F.col("anomalies"), F.lit(1))
    return one.select(
        "total_rows", "anomalies", "total_frauds", "frauds_caught",
        (F.col("total_rows") - F.col("anomalies")).alias("normal"),
        F.round(100 * rec, 1).alias("recall_pct"),
        F.round(100 * prec, 1).alias("precision_pct"),
        F.round(F.when(rec + prec > 0, 200 * rec * prec / (rec + prec)).otherwise(0.0), 1).alias("f1_pct"),
    )


def sweep(det: Detection, rates: list[float] = (0.01, 0.02, 0.05, 0.10)) -> DataFrame:
    """Flagged count per contamination rate from one scoring pass (only the cut moves)."""
    cuts, n = cut_for(det.scored, det.forest, list(rates))
    spark = det.scored.sparkSession
    expr = [F.count_if(F.col("path_units") < F.lit(t)).cast("long").alias(f"r{i}") for i, (t, _) in enumerate(cuts)]
    counts = det.scored.agg(*expr)
    stack = ", ".join(f"CAST({r!r} AS DOUBLE), r{i}" for i, r in enumerate(rates))
    out = counts.select(F.expr(f"stack({len(rates)}, {stack}) AS (contamination, anomalies_found)"))
    return out.select("contamination", "anomalies_found",
                      F.format_string("%.1f%%", 100.0 * F.col("anomalies_found") / F.lit(float(max(n, 1))))
                      .alias("anomaly_pct"))


def flagged_share(det: Detection) -> DataFrame:
    s = det.scored.where(F.col("path_units").isNotNull())
    return s.agg(F.count(F.lit(1)).cast("long").alias("n"),
                 F.count_if(F.col("flagged")).cast("long").alias("anomalies"),
                 F.count_if(~F.col("flagged")).cast("long").alias("normal")) \
            .withColumn("anomaly_pct", F.round(100.0 * F.col("anomalies") / F.greatest(F.col("n"), F.lit(1)), 1))
