"""What the operators share: staged tables, text batches, components, linking.

Words are runs of bytes other than space and the controls 9 to 13, which is
exactly how `bytes.split()` cuts UTF-8 text, so texts are handled as bytes.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.session import scratch_dir


@contextmanager
def _shuffles_go(spark: SparkSession):
    """What is written within leaves no shuffle files: otherwise they wait for the driver's garbage collector, beside the table made from them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once under spark.checkpoint.dir and read it back: a lineage cut that survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    with _shuffles_go(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like `stage`, in as many buckets of `key` as there are shuffle partitions, so that grouping by `key` reads them without a shuffle.

    Tasks write their rows to the buckets as they come; made for tables of few, large rows.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    with _shuffles_go(spark):
        df.write.bucketBy(shuffle_partitions(spark), key).format("parquet").option("path", scratch_dir(spark, name)).saveAsTable(table)
    return spark.table(table)


def unstage(*tables: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes the empty text."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def portions(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows of about `most_bytes` of text; one long row stands alone."""
    ends = batch.column(column).cast(pa.binary())
    start, held = 0, 0
    for i, size in enumerate(ends.to_pylist()):
        size = len(size or b"")
        if i > start and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text under fixed names, whatever else the table holds."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))


_KEPT: dict = {}  # in a worker


def kept(owner, make: Callable):
    """`make()`, once in a worker for all tasks of `owner`, until those of another come."""
    release(owner)
    if owner not in _KEPT:
        _KEPT[owner] = make()
    return _KEPT[owner]


def release(owner=None) -> None:
    """Drops what is kept for others than `owner`: workers are reused, and held a finished stage's tables through all later ones."""
    if _KEPT.keys() - {owner}:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """Returns freed memory to the system: a reused worker kept what its largest task once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text_col: str = "text", owner=None) -> DataFrame:
    """Apply `fn` to bounded portions of every Arrow batch; `owner` names what it keeps in a worker."""
    def run(batches):
        release(owner)
        for batch in batches:
            for part in portions(batch, text_col):
                yield fn(part)
        give_back()
    return df.mapInArrow(run, schema)


BITS = 1 << 25  # of the map of ids: 4 MB, whatever the input; ids beyond make it pass more rows, never fewer


def _bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BITS)) + 1


def bitmap(values: DataFrame, bit: Column):
    """A broadcast map of the bits (from 1) of `values`."""
    maps = values.groupBy(F.bitmap_bucket_number(bit).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    whole = np.zeros(BITS // 8, np.uint8)
    for r in maps:
        part = np.frombuffer(r["bits"], np.uint8)
        whole[(r["at"] - 1) * len(part):r["at"] * len(part)] = part
    return values.sparkSession.sparkContext.broadcast(whole)


def marked(whole: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bits (from 0) are set."""
    return ((whole[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def rows_of(df: DataFrame, ids: DataFrame, id_col: str, fn: Callable, schema: str) -> DataFrame:
    """Apply `fn` to Arrow batches of the rows of `df` whose id may be among `ids`; a few others pass as well.

    A bitmap of hashed ids goes to the tasks, so the rows of `df` are not shuffled. A null is an id.
    """
    bit = _bit(id_col)
    shared = bitmap(ids, bit)

    def run(batches):
        for batch in batches:
            keep = marked(shared.value, batch.column("_bit").to_numpy(zero_copy_only=False) - 1)
            if keep.any():
                yield from fn([batch.filter(pa.array(keep))])
    return df.withColumn("_bit", bit).mapInArrow(run, schema)


def _stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v), v < u, goes straight to the root of a star."""
    twice = edges.groupBy("u").count().where("count > 1").limit(1).count()
    return not twice and not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (node, component), component the smallest node.

    Alternating large-star and small-star rounds, each a grouped minimum and a
    join, staged in the shared folder; the edge table never grows. Nodes
    without a link don't appear; loops and repeated links are harmless.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, stage(least.select("u", F.col("m").alias("v")).unionByName(small).distinct(), "edges")
        unstage(before)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


CENTRES = 8  # nodes of a key that a round holds the others against


def connect(postings: DataFrame | list[DataFrame], attrs: list[str], near: Callable, verify: Callable[[DataFrame], DataFrame], often: int = 2, spent: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Components of the nodes that share a key and pass `verify`, without all pairs of a key.

    `postings` has key, node and `attrs`; repeated rows count once. Given as several tables, each of which has
    all rows of its keys, they are dealt out one after the other, so that the shuffle of one is on disk at a time. The staged tables `spent` are read for
    them only and go when the first round has its rows. A round holds the nodes of every key
    against a few of them (those with the lowest hashes of the round), skipping
    pairs within one component, and joins components along the verified links.
    So a group of k similar nodes grows together from a few times k pairs.
    A key that has no more than `CENTRES` pairs a posting (nodes in different
    components) gives them all at once and is done, so most postings are read in one
    round only. Rounds go on while they find many links and the pairs that are left
    are more than `often` times the postings (a round meets `CENTRES` times the
    postings at most); then all that are left are verified, so no link
    that would join two components is missed.
    `near()` is a cheap condition on prefixed columns (a_, b_); `verify` takes
    distinct pairs (a, b) and returns the true links, staged. Returns (node, component)
    of all nodes that have a link.
    """
    side = lambda df, p: df.select("key", *[F.col(c).alias(f"{p}_{c}") for c in ("component", "node", *attrs)])
    pair = [F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")]
    found, tested, merged = None, None, 1
    for turn in range(1 << 30):
        # `share` divides a key's pairs among its postings, so it sums to the pairs of all keys.
        if found is None:  # one shuffle by key serves to drop repeated rows and to measure the keys
            own, opened = Window.partitionBy("key"), []
            for some in postings if isinstance(postings, list) else [postings]:
                dealt = some.select("key", "node", *attrs).repartition(shuffle_partitions(some.sparkSession), "key").distinct()
                sized = dealt.select("*", F.min("node").over(own).alias("low"), F.max("node").over(own).alias("high"), ((F.count(F.lit(1)).over(own) - 1) / 2).alias("share"))
                opened.append(stage(sized.where("low < high").select("key", "node", *attrs, "share"), "open"))
            placed = reduce(DataFrame.unionByName, opened)
            unstage(*spent)
            spent = (placed,)
            placed = placed.withColumn("component", F.col("node"))
        else:
            joined = stage(postings.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
            sizes = joined.groupBy("key", "component").agg(F.count(F.lit(1)).cast("double").alias("n"))
            sizes = sizes.groupBy("key").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2 / F.sum("n")).alias("share")).where("share > 0")
            placed = stage(joined.join(sizes, "key"), "open")
            unstage(joined, *spent)
            spent = (placed,)
        wide = placed.where(F.col("share") > CENTRES)
        postings = wide.select("key", "node", *attrs)
        rows, left, pairs_left = placed.agg(F.count(F.lit(1)), F.count_if(F.col("share") > CENTRES), F.sum("share")).first()
        if not rows:
            break
        last = not left or pairs_left <= often * rows or (turn > 0 and 50 * merged < left)
        paired = placed if last else placed.where(F.col("share") <= CENTRES)
        met = side(paired, "a").join(side(paired, "b"), "key").where("a_component < b_component")
        if not last:
            centres = wide.groupBy("key").agg(*[F.min(F.struct(F.xxhash64("node", F.lit(turn * CENTRES + i)).alias("h"), "component", "node", *attrs)).alias(f"c{i}") for i in range(CENTRES)])
            centres = centres.select("key", F.explode(F.array_distinct(F.array(*[F.col(f"c{i}").dropFields("h") for i in range(CENTRES)]))).alias("c"))
            met = met.unionByName(side(centres.select("key", "c.*"), "a").join(side(wide, "b"), "key").where("a_component <> b_component"))
        met = met.where(near()).select(*pair).distinct()
        met = stage(met if tested is None else met.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = met if tested is None else tested.unionByName(met)
        new = verify(met)
        merged = new.count()
        if merged:  # what is joined so far goes on as stars
            before, found = found, components(new if found is None else new.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b"))))
            unstage(*[before] if before is not None else [])
        unstage(new)
        if last:
            break
    unstage(*[tested] if tested is not None else [])
    if found is None:
        return postings.select("node", F.col("node").alias("component")).limit(0)
    unstage(*spent)
    return found
