"""N-gram Jaccard join by grouped prefixes.

A document's set holds its distinct 5-word shingles. Two sets link when their
Jaccard similarity is at least 0.8, so they must share one of the first
n - ceil(0.8 n) + 1 shingles in any fixed order of all shingles. The order
here is by how often a shingle's cell of a counting sketch over all documents
was hit, rare first: passages that many documents share come last and stay
out of the prefixes.

Documents with the same set are one node. Sets of one size with the same
prefix are one group, and groups are held against each other by prefix: a
prefix shingle that only one group has, and that group a single set, can't
give a pair and is dropped. The rest is paired through `common.connect`
under the length and position filters, expanded to the member sets, and every
candidate is verified on the whole sets.

Shingles, prefixes and sets are named by 64-bit hashes.

Defined cases: null and empty texts have an empty set, link with nothing and
are their own component; fewer than five words are one shingle; a null id is
carried, but links with nothing (its component is null); a repeated row links
with its copy; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import as_bytes, connect, give_back, narrow, portions, rows_of, shuffle_partitions, stage, stage_buckets, unstage
from vigil.llm.packed import REQUEST, answers, differing, mixed, requests, shrink, totals, widen

SHINGLE, PERCENT = 5, 80
CELLS, SKETCH_ROWS = 1 << 20, 16   # counters of the sketch; rows it travels in
_STEP_KEY = np.uint64(0xD6E8FEB86659FD93)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

RECIPE = "batch long, doc_ids array<long>, sizes array<int>, sets binary, groups binary, prefix_sizes array<int>, prefixes binary"


def shingle_sets(raws: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [raw.lower().split() for raw in raws]
    flat = [w for ws in words for w in ws]
    if not flat:
        return [np.empty(0, np.uint64)] * len(raws)
    codes, names = pd.factorize(np.array(flat, dtype=object))
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))[codes]
    run = h[:max(0, len(h) - width + 1)]
    for k in range(1, width):
        run = mixed(run * _STEP_KEY + h[k:len(run) + k] + np.uint64(k))
    out, start = [], 0
    for ws in words:
        n = len(ws)
        if n >= width:
            out.append(np.unique(run[start:start + n - width + 1]))
        elif n:
            short = h[start:start + 1]
            for k in range(1, n):
                short = mixed(short * _STEP_KEY + h[start + k:start + k + 1] + np.uint64(k))
            out.append(mixed(short + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
        start += n
    return out


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n) // 100 + 1


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes + np.uint64(CELLS)) & np.uint64(CELLS - 1)).astype(np.int64)


def sketch(docs: DataFrame) -> np.ndarray:
    """How many (document, shingle) pairs hit each cell, over all documents: a fixed 4 MB."""
    def count(batches):
        cells = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for part in portions(batch, "text"):
                sets = shingle_sets(as_bytes(part.column("text")))
                cells += np.bincount(_cells(np.concatenate(sets)), minlength=CELLS).astype(np.uint32)
        if cells.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_ROWS), pa.int32()), pa.array([shrink(x) for x in np.split(cells, SKETCH_ROWS)], pa.binary())], names=["row", "cells"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        whole = sum(widen(x, np.uint32).astype(np.int64) for x in group["cells"])
        return pd.DataFrame({"row": group["row"].iloc[:1], "cells": [shrink(np.minimum(whole, 0xFFFFFFFF).astype(np.uint32))]})
    rows = docs.select("text").mapInArrow(count, "row int, cells binary").groupBy("row").applyInPandas(add, "row int, cells binary").collect()
    out = np.zeros(CELLS, np.uint32)
    for r in rows:
        width = CELLS // SKETCH_ROWS
        out[r["row"] * width:(r["row"] + 1) * width] = widen(r["cells"], np.uint32)
    return out


def _recipes(shared):
    def run(batches):
        part, made, counts = TaskContext.get().partitionId(), 0, shared.value
        for batch in batches:
            for piece in portions(batch, "text"):
                sets = shingle_sets(as_bytes(piece.column("text")))
                prefixes = [s[np.argsort(counts[_cells(s)], kind="stable")[:prefix_size(len(s))]] if len(s) else s for s in sets]
                name = lambda x, n: xxhash.xxh3_64_intdigest(x.tobytes(), seed=n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 24 | made], pa.int64()), pa.array([piece.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([[len(s) for s in sets]], pa.list_(pa.int32())),
                     pa.array([np.array([name(s, 0) for s in sets], np.uint64).tobytes()], pa.binary()),
                     pa.array([np.array([name(p, len(s)) for p, s in zip(prefixes, sets)], np.uint64).tobytes()], pa.binary()),
                     pa.array([[len(p) for p in prefixes]], pa.list_(pa.int32())), pa.array([np.concatenate(prefixes).tobytes()], pa.binary())],
                    names=["batch", "doc_ids", "sizes", "sets", "groups", "prefix_sizes", "prefixes"])
                made += 1
    return run


class _Batch:
    def __init__(self, row):
        self.ids = [None if i is None or i != i else int(i) for i in row["doc_ids"]]
        self.sizes = np.asarray(row["sizes"], np.int64)
        self.sets, self.groups = np.frombuffer(row["sets"], np.uint64), np.frombuffer(row["groups"], np.uint64)
        lens = np.asarray(row["prefix_sizes"], np.int64)
        self.tokens = np.frombuffer(row["prefixes"], np.uint64)
        self.owner = np.repeat(np.arange(len(lens)), lens)
        self.place = np.arange(len(self.tokens)) - np.repeat(np.cumsum(lens) - lens, lens)


def _extremes(keys: np.ndarray, values: np.ndarray):
    """Distinct keys with the smallest and the largest of their values, and each entry's key number."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    low, high = np.full(len(distinct), _NONE), np.zeros(len(distinct), np.uint64)
    np.minimum.at(low, inverse, values)
    np.maximum.at(high, inverse, values)
    return distinct, low, high, inverse


def _order(ids) -> np.ndarray:
    """Ids as unsigned numbers in the same order; a null is the largest."""
    return np.array([(1 << 64) - 1 if i is None else i + (1 << 63) for i in ids], np.uint64)


TOKEN, GROUP, SET = 1, 2, 3


def _ask(slices: int):
    def run(batches):
        for rows in batches:
            for row in rows.to_pylist():
                b = _Batch(row)
                full = b.sizes > 0
                for kind, keys, values in ((TOKEN, b.tokens, b.groups[b.owner]), (GROUP, b.groups[full], b.sets[full]), (SET, b.sets[full], _order(b.ids)[full])):
                    if len(keys):
                        distinct, low, high, _ = _extremes(keys, values)
                        yield requests(row["batch"], kind, distinct, low, high, slices)
    return run


#: Rows of two kinds: a document (token null), and a prefix shingle of a node that may pair.
FOUND = "token long, doc_id long, node long, size int, place int, leader long"


def _emit(_, recipe: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
    b = _Batch(recipe.iloc[0])
    two = (np.uint64, np.uint64)
    full = np.flatnonzero(b.sizes > 0)
    distinct = np.unique(b.sets[full], return_inverse=True)
    leader = answers(frame, SET, two)[0][distinct[1]] if len(full) else np.empty(0, np.uint64)
    several = np.zeros(len(b.sizes), bool)
    leads = np.zeros(len(b.sizes), bool)
    if len(full):
        several[full] = differing(frame, GROUP)[np.unique(b.groups[full], return_inverse=True)[1]]
        leads[full] = (_order(b.ids)[full] == leader) & (leader != _NONE)
        shared = differing(frame, TOKEN)[np.unique(b.tokens, return_inverse=True)[1]]
    else:
        shared = np.zeros(0, bool)
    take = np.flatnonzero(leads[b.owner] & (shared | several[b.owner]))
    docs = pd.DataFrame({"token": pd.array([None] * len(b.ids), "Int64"), "doc_id": pd.array(b.ids, "Int64"), "node": pd.array(b.sets.view(np.int64), "Int64"),
                         "size": b.sizes, "place": 0, "leader": pd.array([None] * len(b.ids), "Int64")})
    who = b.owner[take]
    ids = pd.array(b.ids, "Int64")[who]
    posts = pd.DataFrame({"token": pd.array(b.tokens[take].view(np.int64), "Int64"), "doc_id": ids, "node": pd.array(b.sets[who].view(np.int64), "Int64"),
                          "size": b.sizes[who], "place": b.place[take], "leader": ids})
    return pd.concat([docs, posts])


def _verifier(docs: DataFrame, leaders: DataFrame):
    """pairs (a, b) of nodes -> those whose sets link. Sets are made anew from the leaders' texts."""
    def rebuilt(batches):
        for batch in batches:
            for part in portions(batch, "text"):
                sets = shingle_sets(as_bytes(part.column("text")))
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes(), seed=0) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "members"])
        give_back()

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    def verify(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        ids = wanted.join(leaders, "node").select(F.col("leader").alias("doc_id")).distinct()
        sets = rows_of(docs, ids, "doc_id", rebuilt, "node long, members binary").dropDuplicates(["node"])  # both joins read one shuffle of it
        side = lambda name, value: sets.select(F.col("node").alias(name), F.col("members").alias(value))
        return stage(pairs.join(side("b", "y"), "b").join(side("a", "x"), "a").select("a", "b", "x", "y").mapInArrow(linked, "a long, b long"), "links")
    return verify


def _near():
    """Sizes within 80 %, and what follows the shared shingle can still give the overlap: 100 i >= 80 (s + t - i)."""
    most = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
    return ((F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * PERCENT)
            & (most * (100 + PERCENT) >= (F.col("a_size") + F.col("b_size")) * PERCENT))


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = df.sparkSession
    docs = narrow(df, id_col, text_col)
    shared = spark.sparkContext.broadcast(sketch(docs))
    recipe = stage_buckets(docs.mapInArrow(_recipes(shared), RECIPE), "recipe", "batch")
    asked = recipe.mapInArrow(_ask(slices or shuffle_partitions(spark)), REQUEST)
    answered = totals(asked, (np.minimum, np.uint64), (np.maximum, np.uint64), differ=(TOKEN, GROUP))
    found = stage(recipe.groupBy("batch").cogroup(answered.groupBy("batch")).applyInPandas(_emit, FOUND), "found")
    unstage(recipe)
    listed = found.where("token IS NULL").select("doc_id", "node", F.col("size").cast("long").alias("n_shingles"))
    postings = found.where("token IS NOT NULL").select(F.col("token").alias("key"), "node", "size", "place")
    leaders = found.where("token IS NOT NULL").groupBy("node").agg(F.min("leader").alias("leader"))
    parts = connect(postings, ["size", "place"], _near, _verifier(docs, leaders))
    listed = listed.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    full = listed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    least = full.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    linked = full.join(least, "part").select("doc_id", "n_shingles", "component_id")
    alone = listed.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that are their component's smallest id (one of repeated rows), all columns kept."""
    named = df.withColumn("_join_id", df[id_col].cast("long"))
    parts = join(df, id_col, text_col)
    first = parts.where("doc_id = component_id").select(F.col("doc_id").alias("_join_id")).distinct()
    kept = named.where("_join_id IS NOT NULL").join(first, "_join_id", "left_semi").dropDuplicates(["_join_id"])
    return kept.unionByName(named.where("_join_id IS NULL")).drop("_join_id")


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
