"""Transaction-shaped views over the driver's test tables.

Each view has the columns the checks and detectors expect:
``transaction_id`` (unique), ``time_elapsed``, ``amount``, ``class`` (0/1
label, may be NULL), feature columns ``v1..vk`` and, where there is one, a
``region`` dimension. Every view has a DuckDB twin in ``VIEW_SQL`` so oracle
queries can be written against the same rows.

All views keep natural keys (no generated ids) and need no shuffle except
``tx_orders`` and ``tx_docs``, which join fact tables to dimensions/labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Feature columns each view offers to the detector.
FEATURES = {
    "tx_events": ["amount", "v1", "v2", "v3"],
    "tx_orders": ["amount", "v1", "v2"],
    "tx_acct": ["amount", "v1"],
    "tx_docs": ["amount", "v1"],
    "tx_card": ["amount", "v1", "v2", "v3"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _micros_since(col: str, start: str):
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{start}', {col})")


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        (F.col("event_id") + 1).alias("transaction_id"),
        (_micros_since("ts", "2024-01-01 00:00:00") / F.lit(1e6)).alias("time_elapsed"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("class"),
        F.get_json_object("props", "$.k").cast("double").alias("v1"),
        F.hour("ts").cast("double").alias("v2"),
        F.col("user_id").cast("double").alias("v3"),
        F.col("event_type").alias("region"),
    )


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions: broadcast is
    # bounded. customer grows with the data, so the planner/AQE picks that join.
    dims = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust = c.join(F.broadcast(dims), c.c_nationkey == dims.n_nationkey).select("c_custkey", "c_acctbal", "r_name")
    return o.join(cust, o.o_custkey == cust.c_custkey, "left").select(
        (F.col("o_orderkey") + 1).alias("transaction_id"),
        (_micros_since("o_orderdate", "1998-01-01 00:00:00") / F.lit(1e6)).alias("time_elapsed"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("class"),
        F.col("c_acctbal").alias("v1"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("v2"),
        F.col("o_custkey").alias("customer_id"),
        F.col("r_name").alias("region"),
    )


def tx_acct(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("transaction_id"),
        F.col("c_nationkey").cast("double").alias("time_elapsed"),
        F.col("c_acctbal").alias("amount"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("class"),
        F.col("c_nationkey").cast("double").alias("v1"),
        F.col("c_mktsegment").alias("region"),
    )


def tx_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("transaction_id"),
        F.lit(0.0).alias("time_elapsed"),
        F.col("n_chars").cast("double").alias("amount"),
        F.col("toxic").alias("class"),
        F.col("quality").cast("double").alias("v1"),
        F.col("source").alias("region"),
    )


def tx_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the card layout; ids are the customers' places, from 1."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        (F.col("c_custkey") + 1).alias("transaction_id"),
        F.col("c_nationkey").cast("double").alias("time_elapsed"),
        F.col("c_nationkey").cast("double").alias("v1"),
        (F.col("c_custkey") % 7).cast("double").alias("v2"),
        F.length("c_mktsegment").cast("double").alias("v3"),
        F.col("c_acctbal").alias("amount"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("class"),
    )


VIEWS = {
    "tx_events": tx_events,
    "tx_orders": tx_orders,
    "tx_acct": tx_acct,
    "tx_docs": tx_docs,
    "tx_card": tx_card,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)


VIEW_SQL = {
    "tx_events": """
        SELECT event_id + 1 AS transaction_id,
               datediff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1e6 AS time_elapsed,
               value AS amount,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS class,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v1,
               CAST(hour(ts) AS DOUBLE) AS v2,
               CAST(user_id AS DOUBLE) AS v3,
               event_type AS region
        FROM events""",
    "tx_orders": """
        SELECT o.o_orderkey + 1 AS transaction_id,
               datediff('microsecond', TIMESTAMP '1998-01-01 00:00:00', o.o_orderdate) / 1e6 AS time_elapsed,
               o.o_totalprice AS amount,
               CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END AS class,
               cu.c_acctbal AS v1,
               CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) AS v2,
               o.o_custkey AS customer_id,
               cu.r_name AS region
        FROM orders o
        LEFT JOIN (SELECT c.c_custkey, c.c_acctbal, r.r_name
                   FROM customer c
                   JOIN nation n ON c.c_nationkey = n.n_nationkey
                   JOIN region r ON n.n_regionkey = r.r_regionkey) cu
          ON o.o_custkey = cu.c_custkey""",
    "tx_acct": """
        SELECT c_custkey AS transaction_id,
               CAST(c_nationkey AS DOUBLE) AS time_elapsed,
               c_acctbal AS amount,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS class,
               CAST(c_nationkey AS DOUBLE) AS v1,
               c_mktsegment AS region
        FROM customer""",
    "tx_docs": """
        SELECT d.doc_id AS transaction_id,
               0.0::DOUBLE AS time_elapsed,
               CAST(d.n_chars AS DOUBLE) AS amount,
               l.toxic AS class,
               CAST(l.quality AS DOUBLE) AS v1,
               d.source AS region
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "tx_card": """
        SELECT c_custkey + 1 AS transaction_id,
               CAST(c_nationkey AS DOUBLE) AS time_elapsed,
               CAST(c_nationkey AS DOUBLE) AS v1,
               CAST(c_custkey % 7 AS DOUBLE) AS v2,
               CAST(length(c_mktsegment) AS DOUBLE) AS v3,
               c_acctbal AS amount,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS class
        FROM customer""",
}


def with_views(sql: str, *extra: tuple[str, str]) -> str:
    """Prefix `sql` with CTEs for every view it mentions, plus `extra` CTEs."""
    ctes = [(n, q) for n, q in VIEW_SQL.items() if n in sql or any(n in e for _, e in extra)]
    ctes += list(extra)
    if not ctes:
        return sql
    body = ",\n".join(f"{n} AS ({q})" for n, q in ctes)
    stripped = sql.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {body},\n{stripped[5:]}"
    return f"WITH {body}\n{sql}"
