"""Benchmark decontamination by winnowing.

A window is `SPAN` consecutive words of a benchmark item, or the whole of a
shorter item. For windows of n words, k-grams of k = (n + 1) // 2 words are
hashed and the smallest hash of every n - k + 1 consecutive ones is kept. Both
sides keep the hash of a window by the same rule, so each shared window shows
as a shared fingerprint: none is missed. Documents that are n words or longer
are winnowed into runs of windows with one fingerprint; the runs whose
fingerprint some item has are extended to their windows, which are compared
word by word with the item windows. Only what is equal counts.

Everything is DataFrame code. Each document window meets at most one row, as
item windows are distinct, so passages shared by many documents or items make
no pairs of documents or of windows. Fingerprints of the benchmark are
broadcast while they number at most `BROADCAST_PRINTS` (8 bytes each), and
joined by a shuffle beyond that.

Defined cases: null or empty text has no words and is clean; an item without
words has no window; a null item_id marks words but has no name to list, so it
counts in n_hit and contaminated only; items repeated under one id count once;
every document row gives one row, null and repeated ids included; an empty
benchmark hits nothing, empty documents give no rows; other columns are
ignored. A document that repeats a word or passage has one run for as long as
the fingerprint stays, so work is linear in its length.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import stage

SPAN = 10
BROADCAST_PRINTS = 500_000
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal(text: Column) -> Column:
    """The words of a text in lower-case ASCII, one space apart; other letters stay as they are."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    return F.trim(F.regexp_replace(lowered, BETWEEN_WORDS, " "))


def words_of(normal_text: Column) -> Column:
    return F.when(normal_text == "", F.array().cast("array<string>")).otherwise(F.split(normal_text, " "))


def with_runs(df: DataFrame, span: int) -> DataFrame:
    """Adds `runs`: (span, first, last, print) of the windows first..last - 1 of `words` that share a fingerprint.

    Each step is a projection of its own that the next one names more than
    once, so none is evaluated anew for every element.
    """
    k = (span + 1) // 2
    width = span - k + 1
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(upto(F.size("words") - (k - 1)), lambda i: F.xxhash64(F.lit(span), *[F.get("words", i + j) for j in range(k)]))
    df = df.withColumn("_grams", grams)
    least = lambda i: F.least(*[F.get("_grams", i + j) for j in range(width)]) if width > 1 else F.get("_grams", i)
    df = df.withColumn("_least", F.transform(upto(F.size("_grams") - (width - 1)), least))
    df = df.withColumn("_starts", F.filter(upto(F.size("_least")), lambda i: (i == 0) | (F.get("_least", i) != F.get("_least", i - 1))))
    run = F.transform("_starts", lambda i, j: F.struct(F.lit(span).alias("span"), i.alias("first"), F.coalesce(F.get("_starts", j + 1), F.size("_least")).alias("last"),
                                                       F.get("_least", i).alias("print")))
    return df.withColumn("runs", run).drop("_grams", "_least", "_starts")


def runs_of_all(df: DataFrame, spans: list[int], *keep: str) -> DataFrame:
    """One row per run of windows of any of the lengths `spans`, with `words` and the columns `keep`."""
    for span in spans:
        df = with_runs(df, span).withColumnRenamed("runs", f"_runs{span}")
    return df.select(*keep, "words", F.inline(F.concat(*[F.col(f"_runs{s}") for s in spans])))


def windows_of(runs: DataFrame) -> DataFrame:
    """One row per window of the runs: span, first and its words as `window`."""
    each = runs.select("*", F.explode(F.sequence("first", F.col("last") - 1)).alias("at")).drop("first", "last")
    return each.withColumnRenamed("at", "first").withColumn("window", F.array_join(F.slice("words", F.col("first") + 1, F.col("span")), " ")).drop("words")


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", span: int = SPAN) -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct windows (win, span, print, window), their items (win, item), and the window lengths that occur."""
    items = benchmark.select(benchmark[id_col].cast("string").alias("item"), normal(benchmark[text_col]).alias("text"))
    items = stage(items.distinct().withColumn("words", words_of(F.col("text"))).withColumn("least_span", F.least(F.lit(span), F.size("words"))).where("least_span > 0"), "items")
    spans = sorted(r[0] for r in items.select("least_span").distinct().collect())  # at most `span` numbers
    made = None
    for n in spans:
        these = windows_of(runs_of_all(items.where(F.col("least_span") == n), [n], "item"))
        made = these if made is None else made.unionByName(these)
    if made is None:
        made = items.selectExpr("item", "0 AS span", "0L AS print", "0 AS first", "text AS window").limit(0)
    made = stage(made.select("item", "span", "print", "window").distinct(), "item_windows")
    windows = stage(made.select("span", "print", "window").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
    return windows, made.join(windows, ["span", "window"]).where("item IS NOT NULL").select("win", "item"), spans or [span]


def hits(docs: DataFrame, windows: DataFrame, spans: list[int]) -> DataFrame:
    """(row, first, last, win): every place of a document (row, words) at which a benchmark window stands."""
    prints = windows.select("print").distinct()
    if prints.count() <= BROADCAST_PRINTS:
        met = runs_of_all(docs, spans, "row").join(F.broadcast(prints), "print", "left_semi")
    else:  # a shuffle of bare fingerprints; the words are fetched for what is left
        bare = runs_of_all(docs, spans, "row").drop("words").join(prints, "print", "left_semi")
        met = bare.join(docs, "row")
    places = windows_of(met).select("row", "span", "first", "window")
    return places.join(windows.drop("print"), ["span", "window"]).select("row", "first", (F.col("first") + F.col("span")).alias("last"), "win")


def decontaminate(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with row numbers, hit places, items of windows).

    The first has row, doc_id, text (normalised) and n_words, the second row,
    first, last (word positions, last exclusive) and win, the third win and item.
    """
    docs = documents.select(F.monotonically_increasing_id().alias("row"), documents[id_col].cast("long").alias("doc_id"), normal(documents[text_col]).alias("text"))
    docs = stage(docs.withColumn("n_words", F.size(words_of(F.col("text"))).cast("long")), "texts")
    windows, items, spans = item_windows(benchmark, span=span)
    found = stage(hits(docs.select("row", words_of(F.col("text")).alias("words")), windows, spans), "hits")
    return docs, found, items


def report(docs: DataFrame, found: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: words, words hit, items found, their digest and the verdict."""
    # Places of one document are at most as many as its words; overlaps are merged in order.
    merged = F.aggregate("places", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
                         lambda got, x: F.struct((got["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"], got["to"]))).alias("n"), F.greatest(got["to"], x["last"]).alias("to")))
    covered = found.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("places")).select("row", merged["n"].alias("n_hit"))
    named = found.select("row", "win").distinct().join(items, "win").select("row", "item").distinct()
    named = named.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("names"))
    out = docs.select("row", "doc_id", "n_words").join(covered, "row", "left").join(named, "row", "left")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(names).cast("long").alias("n_items"),
                      F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    return report(*decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
