"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are laid in a hashed order and cut into blocks of
equal word counts. The mix is a sequence of slots; slot i gets the golden-ratio
point frac((i + 1/2) * phi), which the cumulative slot rates of the sources map
to a source, so every stretch of the mix is near the target weights. The r-th
slot of a source takes its block r modulo its number of blocks. A document's
taken words are the sum over its pieces of the times their blocks are taken.

Everything is DataFrame code. A source that holds most rows is split: ranks
and prefix sums run over hash buckets of bounded size first and over the
buckets' totals second.

Defined cases: null text has size 0; documents of size 0 are kept and take 0;
a null source is a source of its own, last in order; repeated rows count each;
null ids are carried; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm.common import stage

GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 4096       # words of a block in a large source
LEAST_BLOCKS = 512       # blocks of a small source
BUCKET_ROWS = 4096       # rows ranked by one window group
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_table(sized: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """One row per source in code-point order, null last: sk, source_size, docs, weight.

    The order number comes from a range partitioning and the row counts of its
    partitions, so no task sees all sources.
    """
    per = sized.groupBy("sk").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranged = stage(per.repartitionByRange(F.col("sk").isNull(), "sk").sortWithinPartitions(F.col("sk").isNull(), "sk")
                   .withColumn("mid", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("mid", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = (ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    place = F.col("offset") + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    return ranged.withColumn("part", part).join(offsets, "part").select("sk", "source_size", "docs", weight.alias("weight"))


def targets(sources: DataFrame, cap: int = MAX_EPOCHS) -> DataFrame:
    """Adds `target`: shares of all words by weight, none above cap times the source, the excess reshared.

    The share of a unit of weight only rises as sources reach their cap, so
    each pass is one small aggregate and the set of capped sources only grows.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * F.lit(float(cap))
    unit = 0.0
    while True:
        full = limit <= F.col("weight") * F.lit(unit)
        capped, free = sources.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        following = (total - (capped or 0.0)) / free if free else unit
        if following <= unit:
            break
        unit = following
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(unit)))


def _running(df: DataFrame, group: list[str], order: list, value: Column, buckets: Column) -> DataFrame:
    """Adds `start`, the sum of `value` over the rows before, in hash order within each group.

    Rows of a group are dealt into `buckets` ranges of the order hash `h`; the
    window runs within a bucket, and over the buckets' totals.
    """
    unit = (F.shiftrightunsigned("h", 33) / F.lit(float(1 << 31)))
    df = df.withColumn("bucket", F.floor(unit * buckets)).withColumn("value", value)
    inner = Window.partitionBy(*group, "bucket").orderBy(F.shiftrightunsigned("h", 33), *order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*group, "bucket").agg(F.sum("value").alias("value"))
    sums = sums.select(*group, "bucket", F.coalesce(F.sum("value").over(outer), F.lit(0)).alias("base"))
    inside = df.withColumn("inside", F.coalesce(F.sum("value").over(inner), F.lit(0)))
    return inside.join(sums, [*group, "bucket"]).withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside", "value", "bucket")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42,
        weights: tuple[int, ...] = (1, 2, 3), block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken."""
    base = df.select(df[id_col].cast("long").alias("doc_id"), word_count(df[text_col]).alias("size"),
                     F.xxhash64(df[text_col]).alias("content"), df[source_col].cast("string").alias("sk"))
    base = stage(base.withColumn("sk", F.concat(F.lit("="), "sk")), "sized")
    sources = targets(source_table(base, weights))
    blocks = F.greatest(F.floor(F.col("source_size") / F.lit(block_words)), F.least(F.lit(LEAST_BLOCKS), F.col("source_size")))
    # From here on no source key is null ("" stands for null): joins on equality lose nulls.
    sources = sources.withColumn("blocks", blocks.cast("long")).withColumn("sk", F.coalesce("sk", F.lit("")))
    # Slots that a source should get: its target in units of its own blocks.
    sources = stage(sources.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("blocks")).otherwise(0.0)), "mix")
    base = base.withColumn("sk", F.coalesce("sk", F.lit("")))
    taken = block_times(sources)
    docs = base.where("size > 0").join(sources.select("sk", "source_size", "blocks", "docs"), "sk")
    docs = docs.withColumn("h", F.xxhash64("doc_id", "content", F.lit(seed)))
    docs = _running(docs, ["sk"], ["doc_id", "content", "size"], F.col("size"), F.ceil(F.col("docs") / F.lit(BUCKET_ROWS)))
    # Block k of a source of S words and B blocks covers words ceil(k * S / B) to ceil((k + 1) * S / B).
    total, count = F.col("source_size").cast("decimal(19,0)"), F.col("blocks").cast("decimal(19,0)")
    block_of = lambda word: F.floor(word.cast("decimal(19,0)") * count / total).cast("long")
    block_start = lambda k: F.ceil(k.cast("decimal(19,0)") * total / count).cast("long")
    spans = docs.withColumn("first", block_of(F.col("start"))).withColumn("last", block_of(F.col("start") + F.col("size") - 1))
    key = ["sk", "start", "doc_id", "size"]
    pieces = spans.select(*key, "source_size", "blocks", F.explode(F.sequence("first", "last")).alias("block"))
    words = F.least(F.col("start") + F.col("size"), block_start(F.col("block") + 1)) - F.greatest("start", block_start(F.col("block")))
    pieces = pieces.withColumn("words", words)
    got = pieces.join(taken, ["sk", "block"], "left").groupBy(*key).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    whole = got.select("doc_id", "size", "sk", F.col("taken").cast("long").alias("taken"))
    nothing = base.where("size = 0").select("doc_id", "size", "sk", F.lit(0).cast("long").alias("taken"))
    return (whole.unionByName(nothing).join(sources.select("sk", "source_size", "target"), "sk")
            .select("doc_id", "size", "source_size", "target", "taken", F.expr("CASE WHEN sk <> '' THEN substring(sk, 2) END").alias("source")))


def schedule(sources: DataFrame) -> DataFrame:
    """The slots of the mix in order: slot, sk, rank (of the slot among its source's).

    Points find their source by an equal grid of cells over [0, 1): a source
    is listed in the cells its interval meets, so the join is on the cell.
    """
    spark = sources.sparkSession
    n, total = sources.agg(F.count(F.lit(1)), F.sum("rate")).first()
    slots, cells = int(round(total or 0.0)), 1
    while cells < 4 * n:
        cells *= 2
    # Cumulative rates; sources are ordered by a hash and summed in two steps, like the documents.
    laid = _running(sources.where("rate > 0").withColumn("h", F.xxhash64("sk")).withColumn("one", F.lit(1)), ["one"], ["sk"], F.col("rate"),
                    F.lit(max(1, n // BUCKET_ROWS)))
    share = laid.select("sk", (F.col("start") / F.lit(total or 1.0)).alias("lo"), ((F.col("start") + F.col("rate")) / F.lit(total or 1.0)).alias("hi"))
    cell = lambda c: F.least(F.floor(c * F.lit(float(cells))), F.lit(cells - 1)).cast("long")
    share = share.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    points = spark.range(slots).select(F.col("id").alias("slot"), F.expr(f"pmod((id + 0.5D) * {GOLDEN!r}D, 1.0D)").alias("u"))
    mapped = points.withColumn("cell", cell(F.col("u"))).join(share, "cell").where("lo <= u AND u < hi").select("slot", "sk")
    chunk = Window.partitionBy("sk", "chunk").orderBy("slot")
    mapped = mapped.withColumn("chunk", F.floor(F.col("slot") / F.lit(1 << 16)))
    earlier = Window.partitionBy("sk").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = mapped.groupBy("sk", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("sk", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return mapped.withColumn("r", F.row_number().over(chunk)).join(counts, ["sk", "chunk"]).select("slot", "sk", (F.col("base") + F.col("r") - 1).alias("rank"))


def block_times(sources: DataFrame) -> DataFrame:
    """(sk, block, times): how often the schedule takes each block; ranks past the cap supply nothing."""
    slots = schedule(sources).join(sources.select("sk", "blocks"), "sk").where(F.col("rank") < MAX_EPOCHS * F.col("blocks"))
    return slots.groupBy("sk", (F.col("rank") % F.col("blocks")).alias("block")).agg(F.count(F.lit(1)).alias("times"))


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of `df` as often as the mix takes them, to the nearest whole document; all columns kept.

    A document's count is its taken words over its size, halves up; documents
    without words go, as the mix takes nothing of them.
    """
    counts = mix(df, id_col, text_col, source_col).where("size > 0")
    # Rows that repeat an id share its mean count, so none is lost or gained.
    times = counts.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_mix_id")).agg(
        F.floor(F.sum("taken") / F.sum("size") + F.lit(0.5)).cast("int").alias("_mix_times")).where("_mix_times > 0")
    sized = df.where(word_count(df[text_col]) > 0)
    out = sized.join(times, sized[id_col].cast("long") == times["_mix_id"]).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times"))))
    return out.drop("_mix_id", "_mix_times", "_mix_copy")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
