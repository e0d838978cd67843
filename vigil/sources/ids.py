"""Dense 1-based row ids, without a global sort.

Rows of files are numbered in the order of the files' paths, of the blocks in a
file and of the rows in a block. `with_source` notes where each row was read;
it must be written out (staged) with the rows, as it numbers them in passing.
`with_line_id` then adds up the rows of blocks and files to offsets: the ids
depend on the files alone, not on how a scan is cut into partitions.

`with_dense_id` numbers any frame in scan order. It looks at the frame twice,
so that has to be a scan that gives the same partitions again, such as of a
staged table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_POS_MASK = (1 << 33) - 1

FILE, BLOCK, SEEN = "_source_file", "_source_block", "_source_seen"
BROADCAST_BLOCKS = 100_000


def with_source(df: DataFrame) -> DataFrame:
    """A file scan with the columns FILE, BLOCK and SEEN, which `with_line_id` reads."""
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), F.monotonically_increasing_id().alias(SEEN))


def with_line_id(staged: DataFrame, name: str = "transaction_id", start: int = 1) -> DataFrame:
    """Numbers rows staged after `with_source`, from `start` without gaps."""
    blocks = staged.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("_n"), F.min(SEEN).alias("_first"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = blocks.groupBy(FILE).agg(F.sum("_n").alias("_n"))
    files = files.select(FILE, before(Window.orderBy(FILE)).alias("_file_off"))   # one row per file
    offsets = blocks.withColumn("_off", before(Window.partitionBy(FILE).orderBy(BLOCK))).join(files, FILE).select(FILE, BLOCK, "_first", (F.col("_off") + F.col("_file_off")).alias("_off"))
    if blocks.count() <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    rest = [c for c in staged.columns if c not in (FILE, BLOCK, SEEN)]
    # A block's rows are read in one go, so their running numbers have no gaps.
    return staged.join(offsets, [FILE, BLOCK]).select((F.col("_off") + F.col(SEEN) - F.col("_first") + start).cast("long").alias(name), *rest)


def with_dense_id(df: DataFrame, name: str = "transaction_id", start: int = 1) -> DataFrame:
    """Numbers the rows of a repeatable scan in its order, from `start` without gaps."""
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_part", F.shiftright("_mid", 33)).withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_POS_MASK)))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # Running sum over one row per partition: the window sees only that tiny frame.
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_part")
    return out.select((F.col("_off") + F.col("_pos") + F.lit(start)).cast("long").alias(name), *df.columns)
