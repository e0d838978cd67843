"""Quality rules by compression bands.

Every whole text is compressed with zstandard, once as a whole and once in
fixed chunks. Repetitive text shrinks far more than prose of the same length
and random text hardly at all, so a document is rejected when its ratio
(compressed / raw bytes) leaves the limits of its length band, or when more
than `CHUNK_SHARE` of its full chunks leave the chunk limits. Counts of words,
symbols, repeated lines and repeated word windows come with the verdict.

Defined cases: null or empty text counts nothing and has null ratios (it
fails the base rule, having fewer than 20 words); a null id is carried; every
input row gives one row; other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from vigil.llm.common import as_bytes, map_batches, narrow

#: (bytes below, lowest ratio, highest ratio) of whole documents. Short texts
#: cannot be rejected as incompressible: the frame alone outweighs them.
BANDS = ((256, 0.35, float("inf")), (1 << 10, 0.28, 0.95), (4 << 10, 0.22, 0.82),
         (16 << 10, 0.20, 0.72), (64 << 10, 0.18, 0.68), (float("inf"), 0.15, 0.68))
CHUNK, CHUNK_LIMITS, CHUNK_SHARE = 4096, (0.18, 0.72), 0.3
LEVEL = 3
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8

_WORD_POINTS = bytes([*range(9, 14), 32, *range(0x80, 0xC0)])  # white space and UTF-8 continuation bytes
_NOT_SYMBOL = bytes(set(range(256)) - set(b"#*$%&|<>"))

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, compression_failed boolean, kept boolean")


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside `window`-word windows that occur at least twice. `window` is a power of two.

    Windows are named exactly, by doubling: a window of 2k words is the pair
    of the names of its two halves. A length at which no window repeats ends it.
    """
    n = len(words)
    if n <= window:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    if n - len(names) < window:  # the second window holds no first occurrence
        return 0
    width = 1
    while width < window:
        pairs = ids[:-width] * n + ids[width:]
        values, ids = np.unique(pairs, return_inverse=True)
        if len(values) == len(ids):
            return 0
        width *= 2
    again = np.bincount(ids)[ids] > 1
    cover = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def compression(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, int, int, bool]:
    """(ratio of the whole, full chunks, chunks outside their limits, failed)."""
    if not raw:
        return None, 0, 0, False
    ratio = len(packer.compress(raw)) / len(raw)
    low, high = next((lo, hi) for below, lo, hi in BANDS if len(raw) < below)
    n = len(raw) // CHUNK
    if n == 1:
        bad = int(not CHUNK_LIMITS[0] <= (ratio if len(raw) == CHUNK else len(packer.compress(raw[:CHUNK])) / CHUNK) <= CHUNK_LIMITS[1])
    else:
        bad = sum(not CHUNK_LIMITS[0] <= len(packer.compress(raw[i * CHUNK:(i + 1) * CHUNK])) / CHUNK <= CHUNK_LIMITS[1] for i in range(n))
    return ratio, n, bad, not low <= ratio <= high or bad > CHUNK_SHARE * n


def measure(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple:
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = repeat_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    ratio, chunks, bad, failed = compression(raw, packer)
    return (len(words), len(raw.translate(None, _WORD_POINTS)), len(raw.translate(None, _NOT_SYMBOL)),
            len(lines) - len(set(lines)), repeated, base_failed, ratio, chunks, bad, failed, not (base_failed or failed))


_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "n_chunks",
          "n_bad_chunks", "compression_failed", "kept"]


def _measured(batch: pa.RecordBatch, column: str) -> list[pa.Array]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    rows = [measure(raw, packer) for raw in as_bytes(batch.column(column))]
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, ratios and the verdict `kept`."""
    def run(batch):
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *_measured(batch, "text")], names=["doc_id", *_NAMES])
    return map_batches(narrow(df, id_col, text_col), run, SCHEMA)


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `df` whose text passes, with all their columns as they were."""
    at = df.columns.index(text_col)
    names = [f"c{i}" for i in range(len(df.columns))]  # columns may have clashing names
    flat = df.toDF(*names)

    def run(batch):
        return batch.filter(_measured(batch, names[at])[-1])
    return map_batches(flat, run, flat.schema, names[at]).toDF(*df.columns)


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
