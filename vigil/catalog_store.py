"""Registered queries over stored tables: loads with broken lines, refreshes,
runs, bucketed joins, two detectors, and the composed jobs with their reports.

Imported by `vigil.catalog`, whose `register` they use.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schemas as SCH
from vigil.catalog import (_EV, HISTORY_DATE, PARAMS, _card_csv, _detect, _distribution_sql, _history_row_sql, _results_sql, det_ctes, long_sql, register)
from vigil.forest_sql import with_ctes
from vigil.functions import draws as DR
from vigil.operators import detect as DT
from vigil.operators import profile as PR
from vigil.operators import quality as Q
from vigil.operators import reports as RP
from vigil.operators import rules as R
from vigil.operators import scaling as SC
from vigil.plans import jobs as J
from vigil.session import scratch_dir
from vigil.sources import csv as CSV
from vigil.sources import ids as ID
from vigil.sources import tables as TB
from vigil.sources.buckets import write_bucketed
from vigil.sources.store import Store
from vigil.sources.views import FEATURES, table, view, with_views

# --------------------------------------------------------------------------
# Lines that do not fit the schema
# --------------------------------------------------------------------------
EVENT_LINES = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                            T.StructField("hour", T.DoubleType()), T.StructField("event_type", T.StringType())])

#: Events as lines of text. By event id, some have text in the place of a number, some two fields only, some one too many.
_LINES_SQL = """
    SELECT *, kind = 0 AS good,
           CASE kind WHEN 1 THEN concat_ws(',', event_id, user_id, 'n/a', event_type) WHEN 2 THEN concat_ws(',', event_id, user_id)
                     WHEN 3 THEN concat_ws(',', event_id, user_id, hour, event_type, 'more')
                     ELSE concat_ws(',', event_id, user_id, hour, event_type) END AS line
    FROM (SELECT event_id, user_id, hour(ts) AS hour, event_type,
                 CASE WHEN event_id % 7 = 3 THEN 1 WHEN event_id % 11 = 5 THEN 2 WHEN event_id % 13 = 8 THEN 3 ELSE 0 END AS kind FROM {events})"""
_LINES = _LINES_SQL.format(events="events")


def _event_load(spark, sf_dir) -> CSV.Load:
    path = scratch_dir(spark, "event_lines")
    spark.sql(_LINES_SQL, events=table(spark, sf_dir, "events")).select("line").write.text(path)
    return CSV.load_checked(spark, path, EVENT_LINES, header=False)


@register("s1_good_rows", f"SELECT event_id, user_id, CAST(hour AS DOUBLE) AS hour, event_type FROM ({_LINES}) WHERE good")
def s1_good_rows(spark, sf_dir):
    return _event_load(spark, sf_dir).rows.select("event_id", "user_id", "hour", "event_type")


@register("s1_quarantined_lines", f"SELECT event_id + 1 AS line_id, line FROM ({_LINES}) WHERE NOT good")
def s1_quarantined_lines(spark, sf_dir):
    return _event_load(spark, sf_dir).quarantine.select("line_id", "line")


@register("s1_load_counts", f"""
    SELECT count(*) AS lines, count_if(good)::BIGINT AS loaded, count_if(NOT good)::BIGINT AS quarantined FROM ({_LINES})""")
def s1_load_counts(spark, sf_dir):
    return _event_load(spark, sf_dir).counts


# --------------------------------------------------------------------------
# Ids over many files
# --------------------------------------------------------------------------
ROWS_OF_A_PART = 250_000  # of each numbering in one task of `s2_ids_over_files`


@register("s2_ids_over_files", """
    SELECT count(*) AS n, 1 AS first_id, count(*) AS last_id, count(*) AS distinct_ids, 0 AS changed, 0 AS out_of_order FROM lineitem""")
def s2_ids_over_files(spark, sf_dir):
    """Lineitem in eight files, numbered twice with scans cut differently: no gaps, the same ids, in the order of the files."""
    path, size = scratch_dir(spark, "lineitem_files"), "spark.sql.files.maxPartitionBytes"
    table(spark, sf_dir, "lineitem").select("l_orderkey").repartitionByRange(8, "l_orderkey").write.parquet(path)
    held, runs = spark.conf.get(size), []
    try:
        for most in ("128m", "100k"):
            spark.conf.set(size, most)
            staged = scratch_dir(spark, "numbered")
            ID.with_source(spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))).write.parquet(staged)
            runs.append(ID.with_line_id(spark.read.parquet(staged), "id"))
    finally:
        spark.conf.set(size, held)
    one, two = runs
    # So many parts, which AQE doesn't merge, as keep the rows of a task below a fixed number.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-spark.read.parquet(path).count() // ROWS_OF_A_PART))
    both = one.repartition(parts, "file", "at").join(two.select("file", "at", F.col("id").alias("again")).repartition(parts, "file", "at"), ["file", "at"])
    files = one.groupBy("file").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
    wrong = files.agg(F.count_if(F.col("hi") - F.col("lo") + 1 != F.col("n")).alias("out_of_order"))
    ids = both.repartition(parts, "id").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") != F.col("again")).alias("changed"))
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return ids.agg(whole("n").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("id").alias("distinct_ids"),
                   whole("changed").alias("changed")).crossJoin(wrong)  # two rows of one


# --------------------------------------------------------------------------
# Refreshes that take place as a whole, chunks that are counted
# --------------------------------------------------------------------------
def _results_store(spark, sf_dir) -> Store:
    store = Store(spark, scratch_dir(spark, "store"), SCH.store_schemas())
    store.refresh({"validation_results": R.results_table(view(spark, sf_dir, "tx_docs"))})
    return store


@register("s6_refresh_from_itself", with_views(f"SELECT * FROM ({_results_sql('tx_docs')}) WHERE NOT rule_passed"), raw=True)
def s6_refresh_from_itself(spark, sf_dir):
    store = _results_store(spark, sf_dir)
    store.refresh({"validation_results": R.failures(store.read("validation_results"))})
    return store.read("validation_results")


@register("s6_failed_refresh", with_views(_results_sql("tx_docs")), raw=True)
def s6_failed_refresh(spark, sf_dir):
    """A refresh that fails at some of its rows leaves the first version, which is what readers get."""
    store = _results_store(spark, sf_dir)
    broken = store.read("validation_results").repartition(8, "id").withColumn(
        "rule_name", F.when(F.col("transaction_id") % 97 == 5, F.raise_error(F.lit("a planted fault"))).otherwise(F.col("rule_name")))
    try:
        store.refresh({"validation_results": broken})
    except PySparkException as fault:
        if "a planted fault" not in str(fault):
            raise
    return store.read("validation_results")


@register("s8_chunk_sizes", """
    SELECT 5 * count(*) AS total_rows, true AS within_limit, 5 * count(*) > 10000 AS several_files FROM orders""")
def s8_chunk_sizes(spark, sf_dir):
    """Rows of each file of a chunked write, read back by the file they lie in."""
    path = scratch_dir(spark, "results_chunked")
    TB.write_table(R.results_table(view(spark, sf_dir, "tx_orders")), path, mode="overwrite", schema=SCH.VALIDATION_RESULTS, max_records_per_file=10000)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("total_rows"), (F.max("n") <= 10000).alias("within_limit"), (F.count(F.lit(1)) > 1).alias("several_files"))


# --------------------------------------------------------------------------
# Columns found by type, infinite values
# --------------------------------------------------------------------------
def _describe_all_sql(tbl: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"""
        SELECT '{c}' AS column_name, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min,
               round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75, round(max(x), 6) AS max
        FROM (SELECT {c}::DOUBLE AS x FROM {tbl})""" for c in cols)


@register("a12_describe_all_columns", _describe_all_sql("lineitem", [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def a12_describe_all_columns(spark, sf_dir):
    return PR.describe(table(spark, sf_dir, "lineitem"))


#: tx_events with infinite, undefined and missing amounts, by transaction id.
_ODD_SQL = """
    SELECT transaction_id, v1, CASE WHEN transaction_id % 97 = 1 THEN CAST('Infinity' AS DOUBLE) WHEN transaction_id % 89 = 2 THEN CAST('-Infinity' AS DOUBLE)
                                    WHEN transaction_id % 83 = 3 THEN CAST('NaN' AS DOUBLE) WHEN transaction_id % 79 = 4 THEN NULL ELSE amount END AS amount
    FROM {events}"""
_ODD = f"odd AS ({_ODD_SQL.format(events='tx_events')}), fin AS (SELECT * FROM odd WHERE isfinite(amount))"


def _odd_events(spark, sf_dir):
    return spark.sql(_ODD_SQL, events=view(spark, sf_dir, "tx_events"))


@register("a13_finite_profile", f"""
    WITH {_ODD}
    SELECT 'amount' AS column_name, count_if(isfinite(amount))::BIGINT AS n_finite, count_if(amount = '-infinity')::BIGINT AS n_neg_inf,
           count_if(amount = 'infinity')::BIGINT AS n_pos_inf, count_if(isnan(amount))::BIGINT AS n_nan, count_if(amount IS NULL)::BIGINT AS n_null,
           (SELECT round(avg(amount), 6) FROM fin) AS mean, (SELECT round(stddev_pop(amount), 6) FROM fin) AS std,
           (SELECT round(min(amount), 6) FROM fin) AS min, (SELECT round(max(amount), 6) FROM fin) AS max
    FROM odd""")
def a13_finite_profile(spark, sf_dir):
    return PR.finite_profile(_odd_events(spark, sf_dir), ["amount"])


@register("a14_histogram_with_tails", f"""
    WITH {_ODD},
    b AS (SELECT min(amount) AS lo, max(amount) AS hi FROM fin),
    c AS (SELECT CAST(least(floor((amount - lo) / (hi - lo) * 40) + 1, 40) AS INTEGER) AS bin, count(*) AS n FROM fin, b GROUP BY ALL
          UNION ALL SELECT 0, count(*) FROM odd WHERE amount = '-infinity' UNION ALL SELECT 41, count(*) FROM odd WHERE amount = 'infinity')
    SELECT e.range::INTEGER AS bin, if(e.range IN (0, 41), NULL, round(lo + (e.range - 1) * ((hi - lo) / 40), 6)) AS bin_lo,
           if(e.range IN (0, 41), NULL, round(lo + e.range * ((hi - lo) / 40), 6)) AS bin_hi, coalesce(n, 0)::BIGINT AS count
    FROM range(42) e CROSS JOIN b LEFT JOIN c ON c.bin = e.range""")
def a14_histogram_with_tails(spark, sf_dir):
    h = PR.histogram(_odd_events(spark, sf_dir), "amount", 40, tails=True)
    inner = F.col("bin").between(1, 40)   # the ends of the tails are infinite
    return h.select("bin", F.when(inner, F.col("bin_lo")).alias("bin_lo"), F.when(inner, F.col("bin_hi")).alias("bin_hi"), "count")


@register("a15_quartiles_with_infinities", f"""
    WITH {_ODD}
    SELECT round(quantile_cont(amount, 0.25), 6) AS q1, round(quantile_cont(amount, 0.5), 6) AS median, round(quantile_cont(amount, 0.75), 6) AS q3
    FROM odd WHERE NOT isnan(amount)""")
def a15_quartiles_with_infinities(spark, sf_dir):
    q = PR.quantiles(_odd_events(spark, sf_dir), "amount", PR.QUARTILES)
    return spark.createDataFrame([tuple(q)], "q1 double, median double, q3 double").select(*[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")])


@register("m1_standardize_infinite", f"""
    WITH {_ODD},
    m AS (SELECT avg(amount) AS mean, stddev_pop(amount) AS std FROM fin)
    SELECT transaction_id, if(isfinite(amount), round((amount - mean) / std, 6), NULL) AS z,
           CASE WHEN amount IS NULL OR isnan(amount) THEN 'missing' WHEN isfinite(amount) THEN 'finite' WHEN amount > 0 THEN 'above' ELSE 'below' END AS kind
    FROM odd, m""")
def m1_standardize_infinite(spark, sf_dir):
    z = SC.standardize(_odd_events(spark, sf_dir).select("transaction_id", "amount"), ["amount"])
    inf = F.lit(float("inf"))
    kind = F.when(F.col("amount").isNull(), "missing").when(F.col("amount") == inf, "above").when(F.col("amount") == -inf, "below").otherwise("finite")
    return z.select("transaction_id", F.when(kind == "finite", F.round("amount", 6)).alias("z"), kind.alias("kind"))


# --------------------------------------------------------------------------
# today's date, draws
# --------------------------------------------------------------------------
@register("f6_current_date", "SELECT true AS dated_today, CAST(count(*) AS BIGINT) AS total_rows FROM tx_docs")
def f6_current_date(spark, sf_dir):
    """A history row stored with today's date. It may be read back after midnight."""
    path = scratch_dir(spark, "history_today")
    TB.write_table(Q.history_row(view(spark, sf_dir, "tx_docs")), path, mode="append", schema=SCH.QUALITY_HISTORY)
    return TB.read_table(spark, path).select(F.datediff(F.current_date(), "record_date").isin(0, 1).alias("dated_today"), "total_rows")


_REGIONS = ["north", "east", "south", "west"]


@register("f8_draws", f"""
    SELECT event_id, {DR.sql_integer(100, 999, "42", "event_id", "'customer'")} AS customer, {DR.sql_choice(_REGIONS, "42", "event_id", "'region'")} AS region FROM events""")
def f8_draws(spark, sf_dir):
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", DR.integer(100, 999, 42, e, "customer").alias("customer"), DR.choice(_REGIONS, 42, e, "region").alias("region"))


# --------------------------------------------------------------------------
# J1-J5 over bucketed tables
# --------------------------------------------------------------------------
def bucketed_store(spark, sf_dir, *names: str, of: str = "tx_events") -> dict:
    """Transactions, check results and outliers of a view, bucketed by transaction."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tx = view(spark, sf_dir, of)
    made = {"transactions": lambda: tx.select("transaction_id", "amount", "class"), "results": lambda: R.results_table(tx),
            "outliers": lambda: DT.anomalies(_detect(spark, sf_dir, of))}
    return {n: write_bucketed(made[n](), n, buckets) for n in names}


@register("j1_failures_bucketed", with_views(f"SELECT transaction_id, rule_name, amount FROM {long_sql('tx_acct', ', amount')} WHERE rule_passed IS FALSE"), raw=True)
def j1_failures_bucketed(spark, sf_dir):
    t = bucketed_store(spark, sf_dir, "transactions", "results", of="tx_acct")
    return R.failures(t["results"]).join(t["transactions"], "transaction_id", "left").select("transaction_id", "rule_name", "amount")


@register("j3_left_bucketed", with_ctes(det_ctes("tx_events", _EV), "SELECT transaction_id, class, if(flagged, round(decision, 6), NULL) AS anomaly_score FROM scored"), raw=True)
def j3_left_bucketed(spark, sf_dir):
    t = bucketed_store(spark, sf_dir, "transactions", "outliers")
    return t["transactions"].join(t["outliers"], "transaction_id", "left").select("transaction_id", "class", "anomaly_score")


@register("j4_frauds_bucketed", with_ctes(det_ctes("tx_events", _EV), "SELECT count_if(flagged AND class = 1)::BIGINT AS frauds_detected FROM scored"), raw=True)
def j4_frauds_bucketed(spark, sf_dir):
    t = bucketed_store(spark, sf_dir, "transactions", "outliers")
    return RP.frauds_detected(t["transactions"], t["outliers"])


@register("j5_orphan_outliers", with_ctes(det_ctes("tx_events", _EV), """
    SELECT transaction_id, round(decision, 6) AS anomaly_score FROM scored s
    WHERE flagged AND NOT EXISTS (SELECT 1 FROM tx_events t WHERE t.transaction_id = s.transaction_id AND t.class = 0)"""), raw=True)
def j5_orphan_outliers(spark, sf_dir):
    """Outliers without a transaction among those of class 0."""
    t = bucketed_store(spark, sf_dir, "transactions", "outliers")
    return RP.orphans(t["outliers"], t["transactions"].where("class = 0")).select("transaction_id", "anomaly_score")


@register("j5_orphan_event_results", with_views(f"""
    SELECT r.transaction_id, r.rule_name FROM ({_results_sql('tx_events')}) r ANTI JOIN (SELECT * FROM tx_events WHERE amount >= 50) t USING (transaction_id)"""), raw=True)
def j5_orphan_event_results(spark, sf_dir):
    """Check results without a transaction among those of 50 and more."""
    t = bucketed_store(spark, sf_dir, "transactions", "results")
    return RP.orphans(t["results"], t["transactions"].where("amount >= 50")).select("transaction_id", "rule_name")


@register("j5_orphan_lineitems_of_open_orders", """
    SELECT l_orderkey, l_linenumber FROM lineitem ANTI JOIN (SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderstatus = 'O') USING (l_orderkey)""")
def j5_orphan_lineitems_of_open_orders(spark, sf_dir):
    """Lineitems whose order is not among the open ones."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = write_bucketed(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "lineitems", buckets, "l_orderkey")
    orders = write_bucketed(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "orders", buckets, "l_orderkey")
    return RP.orphans(lines, orders.where("o_orderstatus = 'O'"), "l_orderkey")


# --------------------------------------------------------------------------
# A8, A9 over stored outliers of two detectors
# --------------------------------------------------------------------------
SECOND = "OneFeature"
_second = [(n.replace("f_", "g_") if n.startswith("f_") else n, q.replace("f_", "g_")) for n, q in det_ctes("tx_events", ["amount"], scale=False) if n not in ("tx_events", "an", "scored")]
_TWO = det_ctes("tx_events", _EV) + _second + [
    ("second", "SELECT s._id AS transaction_id FROM g_scores s, g_cut c WHERE s.path_units < c.t_units"),
    ("counted", """SELECT t.*, (s.flagged)::INT + (t.transaction_id IN (SELECT transaction_id FROM second))::INT AS hits, s.flagged AS forest
                   FROM tx_events t JOIN scored s USING (transaction_id)""")]


def _two_detectors(spark, sf_dir):
    """(transactions, stored outliers): those of the forest over all features and those of the amount alone."""
    store = Store(spark, scratch_dir(spark, "store"), SCH.store_schemas())
    both = _detect(spark, sf_dir, "tx_events")
    store.refresh({"anomalies": DT.anomalies(both)})
    one = _detect(spark, sf_dir, "tx_events", ["amount"], scale=False)
    one.method = SECOND
    store.append("anomalies", DT.anomalies(one, method_index=1), run_id=SECOND)
    return view(spark, sf_dir, "tx_events").select("transaction_id", "amount", "class"), store.read("anomalies")


@register("a8_two_detectors", with_ctes(_TWO, """
    SELECT class AS is_fraud, if(hits > 0, 'Flagged', 'Not Flagged') AS status, sum(greatest(hits, 1))::BIGINT AS cnt FROM counted GROUP BY ALL"""), raw=True)
def a8_two_detectors(spark, sf_dir):
    return RP.fraud_breakdown(*_two_detectors(spark, sf_dir))


@register("a8_one_of_two_detectors", with_ctes(_TWO, """
    SELECT class AS is_fraud, if(forest, 'Flagged', 'Not Flagged') AS status, count(*) AS cnt FROM counted GROUP BY ALL"""), raw=True)
def a8_one_of_two_detectors(spark, sf_dir):
    return RP.fraud_breakdown(*_two_detectors(spark, sf_dir), method=DT.METHOD)


@register("a9_two_detectors", with_ctes(_TWO, _distribution_sql("counted", "greatest(hits, 1)", "hits")), raw=True)
def a9_two_detectors(spark, sf_dir):
    return RP.amount_distribution(*_two_detectors(spark, sf_dir))


@register("a9_one_of_two_detectors", with_ctes(_TWO, _distribution_sql("counted", "1", "hits - forest::INT")), raw=True)
def a9_one_of_two_detectors(spark, sf_dir):
    return RP.amount_distribution(*_two_detectors(spark, sf_dir), method=SECOND)


# --------------------------------------------------------------------------
# Several runs of a day
# --------------------------------------------------------------------------
_RUNS = (("first", "2024-06-30 08:00:00", "tx_acct"), ("second", "2024-06-30 20:00:00", "tx_docs"))


def _two_runs(spark, sf_dir):
    """The history of two runs of one day; the second one is repeated, which adds nothing."""
    store = Store(spark, scratch_dir(spark, "store"), SCH.store_schemas())
    for run, at, name in (*_RUNS, _RUNS[-1]):
        row = Q.history_row(view(spark, sf_dir, name), record_date=HISTORY_DATE)
        store.append("data_quality_history", Q.with_run(row, run, at), run_id=run)
    return store.read("data_quality_history")


@register("w3_history_by_run", with_views(" UNION ALL ".join(f"SELECT *, '{run}' AS run_id FROM ({_history_row_sql(name, HISTORY_DATE)})" for run, _, name in _RUNS)), raw=True)
def w3_history_by_run(spark, sf_dir):
    return RP.history_ordered(_two_runs(spark, sf_dir)).drop("run_at")


@register("w4_latest_by_run", with_views(f"SELECT quality_score, record_date FROM ({_history_row_sql('tx_docs', HISTORY_DATE)})"), raw=True)
def w4_latest_by_run(spark, sf_dir):
    return RP.latest_score(_two_runs(spark, sf_dir))


# --------------------------------------------------------------------------
# The composed jobs on the customers in the card layout
# --------------------------------------------------------------------------
_CARD = FEATURES["tx_card"]
_JOB_VIEW = """
    SELECT transaction_id, CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS amount, CAST(CAST(v1 AS FLOAT) AS DOUBLE) AS v1,
           CAST(CAST(v2 AS FLOAT) AS DOUBLE) AS v2, CAST(CAST(v3 AS FLOAT) AS DOUBLE) AS v3, class FROM tx_card"""
_CARD_LONG = long_sql("tx_card", ", amount")
_CARD_SUMMARY = f"SELECT rule_name, count_if(rule_passed)::BIGINT AS passed, count_if(NOT rule_passed)::BIGINT AS failed FROM {_CARD_LONG} GROUP BY rule_name"
_CARD_SCORE = f"(SELECT round(100 * (1 - count_if(NOT rule_passed)::DOUBLE / count(*)), 2) FROM {_CARD_LONG})"


def _job_ctes() -> list[tuple[str, str]]:
    """The detector's CTEs over the stored, narrowed columns."""
    ctes = det_ctes("tx_card", _CARD)
    at = next(i for i, (n, _) in enumerate(ctes) if n == "f_rows")
    return [*ctes[:at], ("tx_job", _JOB_VIEW), ("f_rows", "SELECT * FROM tx_job"), *ctes[at + 1:]]


def _run_jobs(spark, sf_dir) -> tuple[Store, dict]:
    root, out = scratch_dir(spark, "job_store"), scratch_dir(spark, "job_reports")
    done = J.run_all(spark, _card_csv(spark, sf_dir, "tx_card"), root, out, n_features=3, record_date=HISTORY_DATE, features=_CARD, params=PARAMS, run_id="run", run_at="2024-06-30 12:00:00")
    return J.open_store(spark, root, 3), done


def _job_report(name: str, schema: str, sql: str, form: str = "array") -> None:
    def query(spark, sf_dir):
        _, done = _run_jobs(spark, sf_dir)
        return TB.read_json_report(spark, done["reports"][name], schema, form)
    query.__name__ = f"job_{name}"
    register(query.__name__, sql, raw=True)(query)


_job_report("validation_summary", "rule_name string, passed long, failed long", with_views(_CARD_SUMMARY))
_job_report("validation_errors", "transaction_id long, rule_name string, amount double", with_views(f"""
    SELECT transaction_id, rule_name, CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS amount FROM {_CARD_LONG}
    WHERE NOT rule_passed QUALIFY row_number() OVER (ORDER BY transaction_id, rule_name) <= 500"""))
_job_report("quality_history", "record_date string, quality_score double, total_rows long, failed_checks long", with_views(f"""
    SELECT '{HISTORY_DATE}' AS record_date, {_CARD_SCORE} AS quality_score, (SELECT count(*) FROM tx_card) AS total_rows,
           (SELECT count(*) FROM {_CARD_LONG} WHERE NOT rule_passed) AS failed_checks"""), "lines")
_job_report("anomalies", "transaction_id long, anomaly_score double, detection_method string, amount double, is_fraud long", with_ctes(_job_ctes(), """
    SELECT transaction_id, round(decision, 6) AS anomaly_score, 'IsolationForest' AS detection_method, amount, class AS is_fraud
    FROM scored WHERE flagged QUALIFY row_number() OVER (ORDER BY round(decision, 6), transaction_id) <= 200"""))
_job_report("fraud_detection_stats", "is_fraud long, status string, cnt long", with_ctes(_job_ctes(), """
    SELECT class AS is_fraud, if(flagged, 'Flagged', 'Not Flagged') AS status, count(*) AS cnt FROM scored GROUP BY ALL"""))
_job_report("amount_distribution", "amount_range string, total long, anomalies long", with_ctes(_job_ctes(), _distribution_sql()))
_job_report("overview", "total_records long, total_checks long, failed_checks long, passed_checks long, quality_score double, "
                        "anomaly_count long, total_frauds long, frauds_detected long", with_ctes(_job_ctes(), f"""
    SELECT count(*) AS total_records, count(*) * 5 AS total_checks, (SELECT count(*) FROM {_CARD_LONG} WHERE NOT rule_passed) AS failed_checks,
           (SELECT count(*) FROM {_CARD_LONG} WHERE rule_passed) AS passed_checks, {_CARD_SCORE} AS quality_score, count_if(flagged)::BIGINT AS anomaly_count,
           count_if(class = 1)::BIGINT AS total_frauds, count_if(flagged AND class = 1)::BIGINT AS frauds_detected FROM scored"""))


@register("job_raw_transactions", with_views(f"""
    SELECT transaction_id, CAST(CAST(time_elapsed AS FLOAT) AS DOUBLE) AS time_elapsed, j.amount, class
    FROM tx_card JOIN (SELECT transaction_id, amount FROM ({_JOB_VIEW})) j USING (transaction_id)"""), raw=True)
def job_raw_transactions(spark, sf_dir):
    root = scratch_dir(spark, "job_store")
    J.validate_csv(spark, _card_csv(spark, sf_dir, "tx_card"), root, 3)
    raw = J.open_store(spark, root, 3).read("raw_transactions")
    return raw.select("transaction_id", *[F.col(c).cast("double").alias(c) for c in ("time_elapsed", "amount")], F.col("class").cast("int").alias("class"))


@register("job_detect_metrics", with_ctes(_job_ctes(), """
    SELECT count(*) AS total_rows, count_if(flagged)::BIGINT AS anomalies, count_if(class = 1)::BIGINT AS total_frauds,
           count_if(flagged AND class = 1)::BIGINT AS frauds_caught FROM scored"""), raw=True)
def job_detect_metrics(spark, sf_dir):
    root = scratch_dir(spark, "job_store")
    J.validate_csv(spark, _card_csv(spark, sf_dir, "tx_card"), root, 3)
    return J.detect(spark, root, _CARD, PARAMS, 3).select("total_rows", "anomalies", "total_frauds", "frauds_caught")
