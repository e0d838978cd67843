"""Tables bucketed and sorted by their key, for joins without a shuffle.

Transactions, check results and outliers share a key. Written once with the
same number of buckets, any two of them join bucket by bucket: neither side is
exchanged, however often reports join them. The rows are dealt by the key
before the write, by the hash that buckets use, so a bucket is one file and its
order holds. `buckets` is the number of the store, the same for all its tables:
about one per 128 MB to 1 GB of the largest one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from vigil.session import scratch_dir

KEY = "transaction_id"


def write_bucketed(df: DataFrame, name: str, buckets: int, key: str = KEY, path: str | None = None) -> DataFrame:
    """Writes `df` in `buckets` sorted buckets of `key`; returns the table.

    The table is named in the session's catalog (buckets are known to the
    catalog only) under `name` and a unique ending, its files lie in `path`
    (default: a scratch folder).
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
       .option("path", path or scratch_dir(spark, name)).saveAsTable(table))
    return spark.table(table)
