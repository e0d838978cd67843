"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of all orders up to `order` with
a uniform share: P(w | h) = sum_k lambda_k(b) c(h_k, w) / c(h_k) + lambda_0(b) / (V + 1),
where h_k are the last k - 1 tokens and b is the bucket (by powers of two) of
the frequency of the longest context. One set of weights per bucket is learned
by expectation-maximisation: a seventh of the training documents is deleted
from the counts, and the weights maximise the likelihood of its n-grams under
the counts of the rest. The final counts are those of all training documents.

Tokens are lower-cased (A-Z) words and one end per document. N-grams are
64-bit hashes; counting goes through `packed`, once per batch of documents and
n-gram, so frequent words are no hot keys. EM runs on a histogram of log
probabilities (steps of `STEP` decades) whose size doesn't depend on the data.

Defined cases: null and empty texts are the end token alone; a null id counts
as the empty string when it is dealt (training); repeated rows count each;
without training documents N is 0, the base score is that of add-one smoothing
over no counts, and the model is uniform; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import as_bytes, narrow, portions, shuffle_partitions, stage
from vigil.llm.packed import REQUEST, answers, mixed, requests, shrink, totals, widen

FOLDS, HELD_OUT, DELETED = 7, 2, 3
BUCKETS, STEP, ROUNDS = 24, 0.02, 60
BATCH_BYTES = 12 << 20
END = np.uint64(0x9E3779B97F4A7C15)    # the end token, also the context before a first word
_STEP_KEY = np.uint64(0xD6E8FEB86659FD93)

RECIPE = "batch long, deleted boolean, doc_ids array<long>, lens array<int>, words binary, seq binary"


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def _recipes(batches):
    """Batches of documents as word numbers; documents of the deleted fold have batches of their own."""
    part, made = TaskContext.get().partitionId(), 0
    held: dict[bool, list] = {False: [], True: []}
    size = {False: 0, True: 0}

    def flush(deleted):
        nonlocal made
        docs, held[deleted], size[deleted] = held[deleted], [], 0
        words = [raw.lower().split() for _, raw in docs]
        codes, names = pd.factorize(np.array([w for ws in words for w in [*ws, None]], dtype=object))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
        codes = codes.astype(np.int32)  # -1 is the end token
        row = pa.RecordBatch.from_arrays(
            [pa.array([part << 24 | made], pa.int64()), pa.array([deleted]), pa.array([[i for i, _ in docs]], pa.list_(pa.int64())),
             pa.array([[len(w) + 1 for w in words]], pa.list_(pa.int32())), pa.array([hashes.tobytes()], pa.binary()), pa.array([shrink(codes)], pa.binary())],
            names=["batch", "deleted", "doc_ids", "lens", "words", "seq"])
        made += 1
        return row

    for batch in batches:
        for piece in portions(batch, "text"):
            for doc_id, raw in zip(piece.column("doc_id").to_pylist(), as_bytes(piece.column("text"))):
                deleted = fold(doc_id) == DELETED
                held[deleted].append((doc_id, raw))
                size[deleted] += len(raw)
                if size[deleted] >= BATCH_BYTES:
                    yield flush(deleted)
    for deleted in (False, True):
        if held[deleted]:
            yield flush(deleted)


class _Tokens:
    """The tokens of one batch and their n-gram keys."""

    def __init__(self, lens, words: bytes, seq: bytes, order: int):
        codes = widen(seq, np.int32)
        hashes = np.append(np.frombuffer(words, np.uint64), END)
        self.lens = np.asarray(lens, np.int64)
        self.ends = np.cumsum(self.lens)
        word = hashes[codes]  # -1 takes the last entry
        n = len(word)
        first = np.zeros(n, bool)
        first[self.ends - self.lens] = True
        previous = np.append(END, word[:-1])
        previous[first] = END
        self.grams = [word]  # key of the k-gram that ends at each token
        shifted = word
        for k in range(1, order):
            # The (k+1)-gram is the k-gram ending one token earlier (END before a start) and the word.
            before = np.append(END, shifted[:-1])
            before[first] = END
            shifted = mixed(before * _STEP_KEY + word + np.uint64(k))
            self.grams.append(shifted)

    def doc_sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.ends - self.lens) if len(self.lens) else np.zeros(0)


def _train_sizes(recipe: DataFrame) -> list[int]:
    """Training tokens and documents: [tokens kept, tokens deleted, documents kept, documents deleted]."""
    docs = recipe.select("deleted", F.explode(F.arrays_zip("doc_ids", "lens")).alias("d"))
    dealt = F.crc32(F.coalesce(F.col("d.doc_ids").cast("string"), F.lit("")).cast("binary")) % FOLDS
    count = lambda x, flag: F.coalesce(F.sum(F.when(F.col("deleted") == flag, x)), F.lit(0))
    return list(docs.where(dealt != HELD_OUT).agg(*[count(x, f).alias(f"{i}{f}") for i, x in enumerate((F.col("d.lens").cast("long"), F.lit(1))) for f in (False, True)]).first())


def _ask(order: int, slices: int):
    def run(batches):
        for rows in batches:
            for row in rows.to_pylist():
                tokens = _Tokens(row["lens"], row["words"], row["seq"], order)
                train = np.repeat([fold(i) != HELD_OUT for i in row["doc_ids"]], row["lens"])
                for k, grams in enumerate(tokens.grams, 1):
                    keys, inverse = np.unique(grams, return_inverse=True)
                    counts = np.bincount(inverse, weights=train, minlength=len(keys)).astype(np.uint32)
                    none = np.zeros_like(counts)
                    yield requests(row["batch"], k, keys, none if row["deleted"] else counts, counts if row["deleted"] else none, slices)
    return run


def _bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(counts + 1)).astype(np.int64), BUCKETS - 1)


def _joined(row, frame: pd.DataFrame, order: int):
    """Tokens of a batch with, per order, counts of each token's n-gram: (in the kept folds, in the deleted fold)."""
    tokens = _Tokens(row["lens"], row["words"], row["seq"], order)
    counts = []
    for k, grams in enumerate(tokens.grams, 1):
        _, inverse = np.unique(grams, return_inverse=True)
        counts.append([a.astype(np.int64)[inverse] for a in answers(frame, k, (np.uint32, np.uint32))])
    return tokens, counts


def _contexts(tokens: _Tokens, counts: list[np.ndarray], docs: int, n: int) -> list[np.ndarray]:
    """Frequency of each order's context: all tokens, then the count of the shorter n-gram one token earlier.

    Before a first word the context is the document start, seen once per document.
    """
    first = np.zeros(len(tokens.grams[0]), bool)
    first[tokens.ends - tokens.lens] = True
    out = [np.full(len(first), n, np.int64)]
    for c in counts[:-1]:
        before = np.append(0, c[:-1])
        before[first] = docs
        out.append(before)
    return out


def _histogram(order: int, n_kept: int, docs_kept: int):
    """Per (bucket, log-probability bins) the number of deleted-fold tokens."""
    def run(_, recipe: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        tokens, counts = _joined(recipe.iloc[0], frame, order)
        counts = [kept for kept, _ in counts]
        contexts = _contexts(tokens, counts, docs_kept, n_kept)
        cols = {"bucket": _bucket(contexts[-1])}
        for k in range(order):
            p = counts[k] / np.maximum(contexts[k], 1)
            cols[f"p{k}"] = np.where(p > 0, np.round(np.log10(np.maximum(p, 1e-300)) / STEP), 1).astype(np.int64)  # 1: zero
        return pd.DataFrame(cols).groupby(list(cols), as_index=False).size().rename(columns={"size": "n"})
    return run


def learn_weights(hist: pd.DataFrame, order: int, v: int) -> np.ndarray:
    """EM: for each bucket the weights of (uniform, order 1, ..., order `order`)."""
    weights = np.zeros((BUCKETS, order + 1))
    for bucket in range(BUCKETS):
        start = np.full(order + 1, 1.0 / (order + 1))
        if bucket == 0 and order > 1:
            start[-1] = 0.0  # an unseen context has no estimate
            start /= start.sum()
        rows = hist[hist["bucket"] == bucket]
        w = start
        if len(rows):
            n = rows["n"].to_numpy(float)
            p = np.stack([np.full(len(rows), 1.0 / (v + 1)), *(np.where(rows[f"p{k}"] == 1, 0.0, 10.0 ** (rows[f"p{k}"] * STEP)) for k in range(order))], 1)
            n = np.append(n, 1.0)  # one imaginary unknown keeps the uniform share above zero
            p = np.vstack([p, [1.0 / (v + 1)] + [0.0] * order])
            for _ in range(ROUNDS):
                share = p * w
                share /= share.sum(1, keepdims=True)
                w = (share * n[:, None]).sum(0) / n.sum()
        weights[bucket] = w
    return weights


def _scorer(order: int, n: int, docs: int, v: int, weights: np.ndarray):
    def run(_, recipe: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        row = recipe.iloc[0]
        tokens, counts = _joined(row, frame, order)
        counts = [a + b for a, b in counts]
        contexts = _contexts(tokens, counts, docs, n)
        mix = weights[_bucket(contexts[-1])]
        p = mix[:, 0] / (v + 1)
        for k in range(order):
            p = p + mix[:, k + 1] * (counts[k] / np.maximum(contexts[k], 1))
        ids = list(row["doc_ids"])
        return pd.DataFrame({
            "doc_id": pd.array([None if i is None or i != i else int(i) for i in ids], "Int64"), "held_out": [fold(None if i is None or i != i else int(i)) == HELD_OUT for i in ids],
            "n_tokens": tokens.lens, "n_known": tokens.doc_sums((counts[0] > 0).astype(np.int64)), "train_tokens": np.full(len(ids), n, np.int64),
            "base_score": tokens.doc_sums(np.log10((counts[0] + 1) / (n + v + 1))), "score": tokens.doc_sums(np.log10(p))})
    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(df: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None) -> DataFrame:
    """Scores of all documents under the model learned from the training documents."""
    spark = df.sparkSession
    slices = slices or shuffle_partitions(spark)
    recipe = stage(narrow(df, id_col, text_col).mapInArrow(_recipes, RECIPE), "recipe")
    answered = stage(totals(recipe.mapInArrow(_ask(order, slices), REQUEST), (np.add, np.uint32), (np.add, np.uint32),
                            lambda first, second: ((first > 0) | (second > 0)).sum()), "totals")
    kept, deleted, docs_kept, docs_deleted = _train_sizes(recipe)
    n = kept + deleted
    v = sum(int(np.frombuffer(r[0], np.int64)[0]) for r in answered.where("batch = -1 AND kind = 1").select("first").collect())  # a number per slice
    answered = answered.where("batch >= 0")
    deleted_rows = recipe.where("deleted")
    spread = answered.join(deleted_rows.select("batch"), "batch", "left_semi")
    hist = (deleted_rows.groupBy("batch").cogroup(spread.groupBy("batch"))
            .applyInPandas(_histogram(order, kept, docs_kept), ", ".join(f"{c} long" for c in ["bucket", *(f"p{k}" for k in range(order)), "n"])))
    bins = hist.groupBy([c for c in hist.columns if c != "n"]).agg(F.sum("n").alias("n")).toPandas()  # bounded by buckets and bins
    weights = learn_weights(bins, order, v)
    return recipe.groupBy("batch").cogroup(answered.groupBy("batch")).applyInPandas(_scorer(order, n, docs_kept + docs_deleted, v, weights), SCORES)


def op10_lm_scores(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
