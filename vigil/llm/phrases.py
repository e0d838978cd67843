"""Phrases of two to four words that occur together, counted in quotient filters.

Texts are lower-cased in ASCII, cut into pieces at punctuation and line breaks
and into words at spaces and tabs. A phrase as frequent as `LEAST` has only
parts as frequent, so each round counts the n-grams whose two (n-1)-grams are:

1. Words are counted per language on Spark; the frequent ones get dense ids,
   one per (lang, word), so that ids tell languages apart. Batches of text
   fetch the ids of their distinct words and keep ids in place of words.
2. For n = 2, 3, 4 a batch packs its candidate n-grams of ids, permutes them
   invertibly and counts them in counting quotient filters (`cqf`), one for
   each range of quotients. The filters of a range are merged in order. A merge
   gives the frequent n-grams with exact counts, and tells every batch by a bit
   per value which of its own are frequent.

Ranges grow in number with the candidates, about `RANGE_KEYS` to a range. A
batch names a value at most once, and the permutation spreads values evenly, so
a phrase or language with a third of all occurrences is no hot key. Scores,
covering phrases and ranks are joins and grouped aggregates over the frequent
phrases only, with products as decimals.

Defined cases: null text is empty, a null lang counts as `und`; a text or
piece without words counts nothing; repeated rows count each; ids are not
looked at; other columns are ignored; empty tables give no rows. A very long
text is one batch by itself.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm import cqf
from vigil.llm.common import as_bytes, portions, release, stage
from vigil.sources.ids import with_dense_id

LEAST = 30            # occurrences of a candidate
LONGEST = 4           # words of a phrase
TOP = 2000            # phrases of a language in the report
COVERED_PERCENT = 80  # share of a phrase's occurrences inside a longer one that drops it
SCALE = 2_000_000     # of the score a / (l + r)
RANGE_KEYS = 1 << 22  # candidate occurrences to a range of quotients
PART_KEYS = 1 << 19   # values of a range that a merge sorts at once
SALTS = 64            # parts of a language that are ranked before its ranks are joined

BREAK = b"."
_TABLE = bytes(x + 32 if 65 <= x <= 90 else 46 if x in b".,;:!?\n\v\f\r" else x for x in range(256))

TOKENS = "batch long, lang string, words array<binary>, counts array<long>, codes binary"
CODED = "batch long, codes binary, ok binary, candidates long"
FILTER = "slice long, batch long, filter binary"
MERGED = "slice long, batch long, bits binary, ids array<long>, f long"


def words_and_breaks(texts: list[bytes]) -> list[bytes]:
    """The words of texts in order, with `BREAK` between pieces and texts."""
    return BREAK.join(texts).translate(_TABLE).replace(BREAK, b" . ").split()


def tokenize(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """A row per language of a portion of texts: its distinct words, their counts, and the text as numbers of these (0 is a break)."""
    df = documents.select(documents[text_col].cast("string").alias("text"), F.coalesce(documents[lang_col].cast("string"), F.lit("und")).alias("lang"))

    def run(batches):
        release()
        place, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in portions(batch, "text"):
                by = defaultdict(list)
                for text, lang in zip(as_bytes(part.column("text")), part.column("lang").to_pylist()):
                    by[lang].append(text)
                rows = []
                for lang, texts in by.items():
                    names = defaultdict(lambda: len(names), {BREAK: 0})
                    tokens = words_and_breaks(texts)
                    codes = np.fromiter(map(names.__getitem__, tokens), np.uint32, len(tokens))
                    counts = np.bincount(codes, minlength=len(names))
                    rows.append((place + made, lang, list(names)[1:], counts[1:], codes.tobytes()))
                    made += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.list_(pa.binary())),
                     pa.array([r[3] for r in rows], pa.list_(pa.int64())), pa.array([r[4] for r in rows], pa.binary())], names=["batch", "lang", "words", "counts", "codes"])
    return df.mapInArrow(run, TOKENS)


def _coded(batch: int, codes: np.ndarray, ok: np.ndarray) -> tuple:
    return batch, codes.tobytes(), np.packbits(ok).tobytes(), int((ok[:-1] & ok[1:]).sum())


def _state(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["batch", "codes", "ok", "candidates"])


def with_ids(tokens: DataFrame, vocabulary: DataFrame, each: DataFrame) -> DataFrame:
    """Batches with ids (0: break or infrequent word) in place of their own numbers; `ok` marks frequent words."""
    known = each.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).groupBy("batch").agg(F.collect_list(F.struct("at", "id")).alias("known"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                pairs = batch.column("known")[i].values
                own, ids = (pairs.field(j).to_numpy() for j in (0, 1))
                codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint32)
                table = np.zeros(max(int(own.max()) + 2, int(codes.max()) + 1), np.uint32)
                table[own + 1] = ids
                named = table[codes]
                yield _state([_coded(batch.column("batch")[i].as_py(), named, named > 0)])
    return tokens.select("batch", "codes").join(known, "batch").mapInArrow(run, CODED)


def _candidates(batch: pa.RecordBatch, i: int, n: int, width: int):
    """(codes, positions, scrambled high, scrambled low) of the n-grams to count in row i."""
    codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint32)
    ok = np.unpackbits(np.frombuffer(batch.column("ok")[i].as_buffer(), np.uint8), count=len(codes)).astype(bool)
    at = np.flatnonzero(ok[:-1] & ok[1:])
    high, low = cqf.scramble(*cqf.pack([codes[at + j] for j in range(n)], width), cqf.bits_of(n, width))
    return codes, at, high, low


def filters(state: DataFrame, n: int, width: int, given: int) -> DataFrame:
    """The counting quotient filters of every batch, one for each of 2 ** given ranges that it has values in."""
    bits = cqf.bits_of(n, width)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                _, at, high, low = _candidates(batch, i, n, width)
                if not len(at):
                    continue
                order, starts = cqf.ordered(high, low, bits)
                counts = np.diff(np.append(starts, len(order)))
                high, low = high[order[starts]], low[order[starts]]
                ranges = (high >> np.uint64(bits[0] - given)).astype(np.int64)
                cuts = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1], [True]]))
                made = [cqf.build(high[a:b], low[a:b], counts[a:b], bits, given) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(ranges[cuts[:-1]]), pa.array([batch.column("batch")[i].as_py()] * len(made), pa.int64()), pa.array(made, pa.binary())],
                                                 names=["slice", "batch", "filter"])
    return state.mapInArrow(run, FILTER)


def merge(asked: DataFrame, n: int, width: int, given: int, least: int) -> DataFrame:
    """Merges the filters of each range: a row per frequent n-gram (ids, f), and one per batch whose bits say which of its values are frequent."""
    bits = cqf.bits_of(n, width)

    def join(group: pd.DataFrame) -> pd.DataFrame:
        place = int(group["slice"].iloc[0])
        sizes = [cqf.length(raw) for raw in group["filter"]]
        ends = np.cumsum(sizes)
        high, low = np.empty(ends[-1], np.uint64), np.empty(ends[-1], np.uint64)
        counts, marks = np.empty(ends[-1], np.uint32), np.empty(ends[-1], bool)  # a text has fewer than 2**31 bytes
        for raw, s, e in zip(group["filter"], sizes, ends):
            high[e - s:e], low[e - s:e], counts[e - s:e] = cqf.read(raw, bits, given, place)
        first, sums = [], []
        for at in cqf.parts(high, bits, given, PART_KEYS):
            order, starts = cqf.ordered(high[at], low[at], bits)
            order = at[order]
            totals = np.add.reduceat(counts[order], starts, dtype=np.uint64)
            frequent = totals >= np.uint64(least)
            marks[order] = np.repeat(frequent, np.diff(np.append(starts, len(order))))
            first.append(order[starts[frequent]])
            sums.append(totals[frequent].astype(np.int64))
        first, sums = np.concatenate(first), np.concatenate(sums)
        ids = cqf.unpack(*cqf.restore(high[first], low[first], bits), n, width)
        told = [np.packbits(marks[e - s:e]).tobytes() for s, e in zip(sizes, ends)]
        return pd.DataFrame({"slice": place, "batch": [*group["batch"], *[None] * len(ids)], "bits": [*told, *[None] * len(ids)],
                             "ids": [*[None] * len(told), *ids.tolist()], "f": [*[None] * len(told), *sums.tolist()]},
                            ).astype({"batch": "Int64", "f": "Int64"})
    return asked.groupBy("slice").applyInPandas(join, MERGED)


def marked(state: DataFrame, merged: DataFrame, n: int, width: int, given: int) -> DataFrame:
    """The batches with `ok` marking the places of frequent n-grams."""
    bits = cqf.bits_of(n, width)
    told = merged.where("batch IS NOT NULL").groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("slice", "bits"))).alias("told"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                codes, at, high, low = _candidates(batch, i, n, width)
                order, starts = cqf.ordered(high, low, bits)
                ranges = (high[order[starts]] >> np.uint64(bits[0] - given)).astype(np.int64)
                sizes = np.diff(np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1], [True]])))
                parts = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=s) for x, s in zip(batch.column("told")[i].values.field(1), sizes)]
                ok = np.zeros(len(codes), bool)
                ok[at[order]] = np.repeat(np.concatenate(parts).astype(bool), np.diff(np.append(starts, len(order))))
                yield _state([_coded(batch.column("batch")[i].as_py(), codes, ok)])
    return state.join(told, "batch").mapInArrow(run, CODED)


def frequent_phrases(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, range_keys: int = RANGE_KEYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words by id: lang, word, id; counts of all frequent 1- to `longest`-grams: ids, f; sums: lang, n)."""
    tokens = stage(tokenize(documents), "tokens")
    each = tokens.select("batch", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select("batch", "lang", "at", "w.words", "w.counts")
    each = each.withColumnRenamed("words", "word").withColumnRenamed("counts", "n")
    totals = stage(each.groupBy("lang", "word").agg(F.sum("n").alias("f")), "word_counts")
    sums = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    common = stage(totals.where(F.col("f") >= least), "common_words")
    vocabulary = stage(with_dense_id(common, "id"), "vocabulary")
    width = max(int(vocabulary.agg(F.max("id")).first()[0] or 0).bit_length(), 1)
    if width > 32:
        raise ValueError("more than 2**32 frequent words")
    counts = vocabulary.select(F.array("id").alias("ids"), "f")
    state = stage(with_ids(tokens, vocabulary, each), "coded")
    for n in range(2, longest + 1):
        keys = state.agg(F.sum("candidates")).first()[0] or 0
        given = min(max(-(-keys // range_keys) - 1, 0).bit_length(), cqf.bits_of(n, width)[0])
        merged = stage(merge(filters(state, n, width, given), n, width, given, least), "merged")
        counts = counts.unionByName(merged.where("batch IS NULL").select("ids", "f"))
        if n < longest:
            state = stage(marked(state, merged, n, width, given), "coded")
    return vocabulary, stage(counts, "phrase_counts"), sums


def scored(counts: DataFrame) -> DataFrame:
    """(ids, a, l, r, score) of every phrase at its lowest cut, less those that a longer phrase covers."""
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = counts.where(F.size("ids") > 1).select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("ids", F.lit(1), F.col("k"))).withColumn("right", F.slice("ids", F.col("k") + 1, F.size("ids")))
    cuts = cuts.join(counts.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left").join(counts.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
    cuts = cuts.withColumn("score", F.expr(f"({SCALE} * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"))
    best = cuts.groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("ids", "a", "cut.l", "cut.r", "cut.score")
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.size("ids") - m + 1), lambda i: F.slice("ids", i, m))))
    covers = counts.where(F.size("ids") > 2).select(F.explode(parts).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("cover"))
    return best.join(covers, "ids", "left").where(F.col("cover").isNull() | (100 * exact("cover") < COVERED_PERCENT * exact("a"))).drop("cover")


def report(vocabulary: DataFrame, counts: DataFrame, sums: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each language."""
    found = scored(counts)
    words = found.select("*", F.posexplode("ids").alias("at", "id")).join(vocabulary.select("id", "lang", F.col("word").cast("string").alias("word")), "id")
    named = words.groupBy("ids", "a", "l", "r", "score").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    named = named.select("lang", F.array_join(F.col("w.word"), " ").alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language is ranked in parts first; what is not among the first of a part is not among the first of all.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    named = named.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    named = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return named.join(sums, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("n").cast("long").alias("n"), F.col("score").cast("long").alias("score"))


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    return report(*frequent_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet")))
