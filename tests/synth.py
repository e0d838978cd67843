"""Seeded source of dirty sample transactions.

One row per input index `i` (1-based). Every value is a hash draw of
(seed, i, purpose), so the same rows come out for any row count, partition
count or executor loss, and a SQL twin can rebuild them. One draw per row
picks at most one injected defect: non-positive amount, missing customer,
blank date, copied id, or an extreme amount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.draws import sql_uniform, uniform

# The ten regions, the date range, amounts and defect rates of
# the sample generator.
REGIONS = ["Delhi", "Mumbai", "Bangalore", "Chennai", "Hyderabad",
           "Kolkata", "Pune", "Ahmedabad", "Jaipur", "Lucknow"]
START_DATE = "2024-01-01"
N_DAYS = 366                      # 2024-01-01 .. 2024-12-31 inclusive
BASE_ID = 1000
CUSTOMER_LO, CUSTOMER_HI = 100, 999
AMOUNT_LO, AMOUNT_HI = 10.0, 500.0
NEG_LO, NEG_HI = -100.0, 0.0
BIG_LO, BIG_HI = 8000.0, 15000.0
# Upper bounds of each defect band of the one draw per row (cumulative).
P_NEGATIVE, P_NO_CUSTOMER, P_BAD_DATE, P_DUPLICATE, P_EXTREME = 0.02, 0.03, 0.04, 0.05, 0.07


def dirty_sample(index: DataFrame, i_col: str = "i", seed: int = 42) -> DataFrame:
    """Columns transaction_id, transaction_date, customer_id, amount, region (+ defect draw)."""
    i = F.col(i_col).cast("long")

    def u(purpose):
        return uniform(seed, i, purpose)

    r = u("defect")
    date = F.date_format(F.date_add(F.lit(START_DATE).cast("date"), F.floor(u("date") * N_DAYS).cast("int")), "yyyy-MM-dd")
    cust = F.lit(CUSTOMER_LO) + F.floor(u("customer") * (CUSTOMER_HI - CUSTOMER_LO + 1))
    amount = F.round(F.lit(AMOUNT_LO) + u("amount") * (AMOUNT_HI - AMOUNT_LO), 2)
    neg = F.round(F.lit(NEG_LO) + u("negative") * (NEG_HI - NEG_LO), 2)
    big = F.round(F.lit(BIG_LO) + u("extreme") * (BIG_HI - BIG_LO), 2)
    region = F.element_at(F.array(*[F.lit(x) for x in REGIONS]), (F.floor(u("region") * len(REGIONS)) + 1).cast("int"))
    # A copied id takes the base id of a random earlier row (row 1 has none).
    copied = F.lit(BASE_ID + 1) + F.floor(u("duplicate") * (i - 1))
    return index.select(
        F.when((r >= P_BAD_DATE) & (r < P_DUPLICATE) & (i > 1), copied).otherwise(F.lit(BASE_ID) + i)
         .cast("long").alias("transaction_id"),
        F.when((r >= P_NO_CUSTOMER) & (r < P_BAD_DATE), F.lit("")).otherwise(date).alias("transaction_date"),
        F.when((r >= P_NEGATIVE) & (r < P_NO_CUSTOMER), F.lit(None)).otherwise(cust).cast("long").alias("customer_id"),
        F.when(r < P_NEGATIVE, neg).when((r >= P_DUPLICATE) & (r < P_EXTREME), big).otherwise(amount)
         .cast("double").alias("amount"),
        region.alias("region"),
        r.alias("defect_draw"),
    )


def dirty_sample_range(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """`n` sample rows from `spark.range` (any size, any partitioning)."""
    return dirty_sample(spark.range(1, n + 1).withColumnRenamed("id", "i"), seed=seed)


def sql_dirty_sample(index_sql: str, i_expr: str = "i", seed: int = 42) -> str:
    """DuckDB twin of `dirty_sample` over a subquery providing `i_expr`."""

    def u(purpose):
        return sql_uniform(str(seed), i_expr, f"'{purpose}'")

    regions = ", ".join(f"'{x}'" for x in REGIONS)
    r = u("defect")
    date = f"strftime(DATE '{START_DATE}' + CAST(floor({u('date')} * {N_DAYS}) AS INTEGER), '%Y-%m-%d')"
    cust = f"({CUSTOMER_LO} + floor({u('customer')} * {CUSTOMER_HI - CUSTOMER_LO + 1}))"
    amount = f"round({AMOUNT_LO} + {u('amount')} * {AMOUNT_HI - AMOUNT_LO}, 2)"
    neg = f"round({NEG_LO} + {u('negative')} * {NEG_HI - NEG_LO}, 2)"
    big = f"round({BIG_LO} + {u('extreme')} * {BIG_HI - BIG_LO}, 2)"
    region = f"([{regions}])[CAST(floor({u('region')} * {len(REGIONS)}) AS INTEGER) + 1]"
    copied = f"({BASE_ID + 1} + floor({u('duplicate')} * ({i_expr} - 1)))"
    return f"""
        SELECT CAST(CASE WHEN r >= {P_BAD_DATE} AND r < {P_DUPLICATE} AND {i_expr} > 1 THEN {copied}
                         ELSE {BASE_ID} + {i_expr} END AS BIGINT) AS transaction_id,
               CASE WHEN r >= {P_NO_CUSTOMER} AND r < {P_BAD_DATE} THEN '' ELSE {date} END AS transaction_date,
               CAST(CASE WHEN r >= {P_NEGATIVE} AND r < {P_NO_CUSTOMER} THEN NULL ELSE {cust} END AS BIGINT) AS customer_id,
               CAST(CASE WHEN r < {P_NEGATIVE} THEN {neg}
                         WHEN r >= {P_DUPLICATE} AND r < {P_EXTREME} THEN {big}
                         ELSE {amount} END AS DOUBLE) AS amount,
               {region} AS region,
               r AS defect_draw
        FROM (SELECT *, {r} AS r FROM ({index_sql}))"""
