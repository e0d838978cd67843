"""Stored tables and report sinks.

Tables are Parquet folders with fixed schemas. Writes are partitioned (the
partitions are the write batches; `max_records_per_file` caps a file), full
refresh is an overwrite, history and results are appends. JSON reports keep
NULL fields (NaN/Inf turned into NULL first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.nulls import nan_to_null
from vigil.schemas import TABLES


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def create_tables(spark: SparkSession, root: str, schemas: dict[str, T.StructType] = TABLES) -> dict[str, str]:
    """Drop-and-create: each table becomes an empty Parquet folder with its schema."""
    paths = {}
    for name, schema in schemas.items():
        p = table_path(root, name)
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_table(df: DataFrame, path: str, mode: str = "append", schema: T.StructType | None = None,
                max_records_per_file: int | None = None, partitions: int | None = None) -> None:
    """Write a table: `overwrite` = full refresh, `append` = add rows.

    `max_records_per_file` bounds each output file (the write batch size);
    `partitions` optionally re-balances the write first.
    """
    if schema is not None:
        df = conform(df, schema)
    if partitions is not None:
        df = df.repartition(partitions)
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Scan a stored table; naming `columns` prunes the Parquet read to them."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.select(*columns) if columns else df


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON record per line, NULL fields kept, NaN/Inf written as null."""
    nan_to_null(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def report_array(df: DataFrame, order_by: list[str]) -> DataFrame:
    """A small report as one text row holding a JSON array of records, in order.

    Only for report-sized frames (the caller bounds them: top-k, per-rule or
    per-bucket rows); the records are gathered into one value by design.
    """
    clean = nan_to_null(df)
    # Columns named with a leading underscore only order the records.
    fields = [F.col(c) for c in clean.columns if not c.startswith("_")]
    keyed = clean.select(F.struct(*[F.col(c) for c in order_by]).alias("_k"), F.struct(*fields).alias("_r"))
    return keyed.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_r"))),
                                           lambda e: e["_r"]), {"ignoreNullFields": "false"}).alias("value"))


def write_report(df: DataFrame, path: str, order_by: list[str], form: str = "array") -> None:
    """Write a report: "array" is one JSON array document, "lines" ordered JSON lines over many files.

    "array" gathers the records into one value, so it is for reports bounded
    by construction (top-k, per-rule, per-bucket rows); a report that grows,
    such as a history, is written as lines.
    """
    if form == "array":
        report_array(df, order_by).coalesce(1).write.mode("overwrite").text(path)
        return
    keep = [c for c in df.columns if not c.startswith("_")]
    write_json_lines(df.orderBy(*order_by).select(*keep), path)


def read_json_report(spark: SparkSession, path: str, schema: T.StructType, form: str = "array") -> DataFrame:
    """Read back a report written by `write_report` with a fixed schema."""
    r = spark.read.schema(schema)
    return (r.option("multiLine", True) if form == "array" else r).json(path)


def publish(df: DataFrame, path: str, jdbc_url: str | None = None, jdbc_table: str | None = None,
            jdbc_props: dict | None = None, batchsize: int = 10000) -> None:
    """Hand a result to a BI tool: a Parquet folder, and optionally a JDBC table."""
    df.write.mode("overwrite").parquet(path)
    if jdbc_url and jdbc_table:
        (df.write.mode("overwrite").option("batchsize", batchsize)
           .jdbc(jdbc_url, jdbc_table, properties=jdbc_props or {}))
