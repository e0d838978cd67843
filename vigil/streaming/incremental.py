"""Incremental checks on arriving files (Structured Streaming).

The rules are row-local, so checking files as they land is the batch
evaluation applied per micro-batch: `foreachBatch` appends the long check
results and one score-history row per batch, idempotently keyed by the batch
id (a replayed batch after a failure rewrites its own partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators import rules as R
from vigil.operators.quality import score_expr


def checked_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                   rules=R.DEFAULT_RULES, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of arriving rows with one boolean column per rule."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(path)
    return R.evaluate_wide(src, rules)


def write_batches(checked: DataFrame, results_path: str, history_path: str, checkpoint: str,
                  rules=R.DEFAULT_RULES, id_col: str = "transaction_id", date_col: Column | None = None):
    """Start the query appending results and a history row per micro-batch.

    The row is dated with the latest `date_col` of the batch, so that a batch
    replayed on a later day gives the same row. Without it, with the day it ran.
    """
    names = [r.name for r in rules]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        pairs = ", ".join(f"'{n}', `{n}`" for n in names)
        long = batch.select(F.col(id_col).cast("long").alias("transaction_id"),
                            F.expr(f"stack({len(names)}, {pairs}) AS (rule_name, rule_passed)"),
                            F.lit(batch_id).cast("long").alias("batch_id"))
        (long.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(results_path))
        failed = sum((F.when(~F.col(n), 1).otherwise(0) for n in names), F.lit(0))
        hist = batch.agg(F.count(F.lit(1)).cast("long").alias("total_rows"),
                         F.coalesce(F.sum(failed), F.lit(0)).cast("long").alias("failed_checks"),
                         (F.current_date() if date_col is None else F.max(date_col).cast("date")).alias("record_date")) \
            .where(F.col("total_rows") > 0) \
            .select("record_date",
                    score_expr(F.col("failed_checks"), F.col("total_rows") * len(names)).alias("quality_score"),
                    "total_rows", "failed_checks", F.lit(batch_id).cast("long").alias("batch_id"))
        (hist.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(history_path))

    return (checked.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).start())
