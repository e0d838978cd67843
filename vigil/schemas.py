"""Fixed table schemas.

The four stored tables of the checking system: loaded transactions, long-form
check results, flagged outliers and the score history. Types are fixed here;
nothing is inferred at read time.
"""

from __future__ import annotations

from pyspark.sql import types as T

N_CARD_FEATURES = 28

# Source CSV header of the card-transaction layout.
CARD_TIME = "Time"
CARD_AMOUNT = "Amount"
CARD_CLASS = "Class"


def card_feature_names(n: int = N_CARD_FEATURES) -> list[str]:
    return [f"V{i}" for i in range(1, n + 1)]


def card_csv_schema(n_features: int = N_CARD_FEATURES) -> T.StructType:
    """Header row Time, V1..Vn, Amount, Class; every column read as double."""
    names = [CARD_TIME, *card_feature_names(n_features), CARD_AMOUNT, CARD_CLASS]
    return T.StructType([T.StructField(n, T.DoubleType(), True) for n in names])


def card_rename_map(n_features: int = N_CARD_FEATURES) -> dict[str, str]:
    """CSV header -> table column names."""
    m = {CARD_TIME: "time_elapsed", CARD_AMOUNT: "amount", CARD_CLASS: "class"}
    m.update({f"V{i}": f"v{i}" for i in range(1, n_features + 1)})
    return m


def raw_transactions_schema(n_features: int = N_CARD_FEATURES) -> T.StructType:
    fields = [
        T.StructField("transaction_id", T.LongType(), False),
        T.StructField("time_elapsed", T.FloatType(), True),
    ]
    fields += [T.StructField(f"v{i}", T.FloatType(), True) for i in range(1, n_features + 1)]
    fields += [
        T.StructField("amount", T.DecimalType(12, 2), True),
        T.StructField("class", T.ByteType(), True),
    ]
    return T.StructType(fields)


VALIDATION_RESULTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("rule_name", T.StringType(), False),
    T.StructField("rule_passed", T.BooleanType(), False),
])

ANOMALIES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("anomaly_score", T.DoubleType(), True),
    T.StructField("detection_method", T.StringType(), False),
])

QUALITY_HISTORY = T.StructType([
    T.StructField("record_date", T.DateType(), False),
    T.StructField("quality_score", T.DoubleType(), True),
    T.StructField("total_rows", T.LongType(), False),
    T.StructField("failed_checks", T.LongType(), False),
])

# The history as it is stored: a score with the run that wrote it. Several runs may fall on one date.
HISTORY_RUNS = T.StructType([
    *QUALITY_HISTORY.fields,
    T.StructField("run_at", T.TimestampType(), False),
    T.StructField("run_id", T.StringType(), False),
])

# Lines of the source that do not fit its schema, and the line counts of each load.
QUARANTINE = T.StructType([
    T.StructField("line_id", T.LongType(), False),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("line", T.StringType(), True),
])

LOAD_COUNTS = T.StructType([T.StructField(n, T.LongType(), False) for n in ("lines", "loaded", "quarantined")])

# Earlier sample-data layout (generator output).
SAMPLE_TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.LongType(), True),
    T.StructField("transaction_date", T.StringType(), True),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("region", T.StringType(), True),
])

# Order dates as text.
ORDER_DATES = T.StructType([
    T.StructField("o_orderkey", T.LongType(), True),
    T.StructField("day", T.StringType(), True),
])

TABLES = {
    "raw_transactions": raw_transactions_schema(),
    "validation_results": VALIDATION_RESULTS,
    "anomalies": ANOMALIES,
    "data_quality_history": QUALITY_HISTORY,
}


def store_schemas(n_features: int = N_CARD_FEATURES) -> dict[str, T.StructType]:
    """The tables that the jobs keep in a store."""
    return {
        "raw_transactions": raw_transactions_schema(n_features),
        "validation_results": VALIDATION_RESULTS,
        "anomalies": ANOMALIES,
        "data_quality_history": HISTORY_RUNS,
        "quarantine": QUARANTINE,
        "load_counts": LOAD_COUNTS,
    }
