"""CSV sources with fixed schemas, broken rows kept apart, column renames and typed narrowing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.schemas import card_csv_schema, card_rename_map, raw_transactions_schema
from vigil.session import scratch_dir
from vigil.sources.ids import FILE, with_line_id, with_source

CORRUPT = "_corrupt_line"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             null_value: str | None = None, corrupt_column: str | None = None) -> DataFrame:
    """PERMISSIVE CSV read with a fixed schema (no inference pass).

    Malformed rows become NULL fields (and, with `corrupt_column`, keep their raw
    text there) instead of failing the job.
    """
    if corrupt_column:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType(), True)])
    reader = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
              .option("nanValue", "NaN").option("positiveInf", "Inf").option("negativeInf", "-Inf"))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


@dataclass
class Load:
    """One parse of CSV files: the rows that fit the schema, the lines that don't, and how many there are of each."""
    rows: DataFrame         # transaction_id and the columns of the schema
    quarantine: DataFrame   # line_id, source_file, line
    counts: DataFrame       # one row: lines, loaded, quarantined


def load_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, null_value: str | None = None,
                 id_col: str = "transaction_id") -> Load:
    """Reads CSV files once; a line with too few or too many fields, or a value not of its type, is quarantined as it stands.

    Lines are numbered over all files (`ids.with_line_id`), broken ones
    included: an id finds its line, and the ids of rows and quarantine
    together have no gaps. The parsed lines are staged, so that rows,
    quarantine and counts come from the same reading.
    """
    parsed = read_csv(spark, path, schema, header, null_value, corrupt_column=CORRUPT)
    staged = scratch_dir(spark, "parsed")
    with_source(parsed).write.parquet(staged)
    lines = spark.read.parquet(staged)
    numbered = with_line_id(lines.withColumn("source_file", F.col(FILE)), id_col)
    broken = F.col(CORRUPT).isNotNull()
    return Load(numbered.where(~broken).drop(CORRUPT, "source_file"),
                numbered.where(broken).select(F.col(id_col).alias("line_id"), "source_file", F.col(CORRUPT).alias("line")),
                lines.agg(F.count(F.lit(1)).cast("long").alias("lines"), F.count_if(~broken).cast("long").alias("loaded"), F.count_if(broken).cast("long").alias("quarantined")))


def load_card_csv(spark: SparkSession, path: str, n_features: int = 28) -> Load:
    """Card layout CSV with table names, source types kept."""
    load = load_checked(spark, path, card_csv_schema(n_features))
    return Load(rename_columns(load.rows, card_rename_map(n_features)), load.quarantine, load.counts)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def narrow(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast each column to the stored type; values that do not fit become NULL."""
    out = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
           for f in schema.fields]
    return df.select(out)


def read_card_csv(spark: SparkSession, path: str, n_features: int = 28) -> DataFrame:
    """Card layout CSV (Time, V1..Vn, Amount, Class), renamed to table names, source types kept."""
    return rename_columns(read_csv(spark, path, card_csv_schema(n_features)), card_rename_map(n_features))


def to_raw_table(df: DataFrame, n_features: int = 28) -> DataFrame:
    """Narrow a renamed card frame (with transaction_id) to the stored table types."""
    return narrow(df, raw_transactions_schema(n_features))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
