"""Sharding by jump consistent hashing: a shard from a stable key and the number of shards alone.

The jump walks a pseudo-random sequence of the key; there is no ring table to hold or to send. With
one more shard a row either stays or goes to the new shard (the ``key`` law). Slots number the rows
of a shard without a gap: rows are dealt to ``buckets`` parts of a shard, counted from the id column
alone, and numbered part by part, so that no task ever sorts a whole shard.

Only counts are broadcast: one row for each shard and bucket.

Defined cases: a null id has the key -1. A null text has no bytes; its CRC-32 is 0. Rows of equal id
share a shard; their slots follow CRC-32 and size, and equal rows take theirs in any order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.shipping import ship

SHARDS = 24
BUCKETS = 128
ROW_BYTES = 8


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, from 0 to ``shards`` - 1, of each uint64 key."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    active, at = np.arange(len(state)), np.zeros(len(state), np.int64)
    while len(active):
        shard[active] = at
        state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
        at = ((at + 1) * (2.0**31 / ((state[active] >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        more = at < shards
        active, at = active[more], at[more]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a bigint key."""

    @F.pandas_udf("int")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy().view(np.uint64), shards).astype(np.int32))

    return run(F.coalesce(key.cast("long"), F.lit(-1).cast("long")))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def assign_shards(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    ship(df.sparkSession)
    key = F.col(id_col).cast("long")
    ids = df.select(key.alias("doc_id")).select("doc_id", shard_of(F.col("doc_id"), shards).alias("shard"))
    counts = ids.groupBy("shard", _bucket(F.col("doc_id"), buckets).alias("bucket")).count()
    before = F.expr("coalesce(sum(count) over (partition by shard order by bucket rows between unbounded preceding and 1 preceding), 0L)")
    offsets = counts.select(F.col("shard").alias("of_shard"), F.col("bucket").alias("of_bucket"), before.alias("offset"))
    docs = df.select(
        key.alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dealt = docs.select(
        "*",
        shard_of(F.col("doc_id"), shards).alias("shard"),
        shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"),
        _bucket(F.col("doc_id"), buckets).alias("bucket"),
    )
    numbered = dealt.withColumn("place", F.expr("row_number() over (partition by shard, bucket order by doc_id, text_crc32, size)"))
    joined = numbered.join(F.broadcast(offsets), F.expr("shard = of_shard and bucket = of_bucket"))
    return joined.selectExpr("doc_id", "size", "text_crc32", "'key' law", "shard", "offset + place - 1 slot", "grown_shard")


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", shards: int = SHARDS, buckets: int = BUCKETS) -> None:
    """Writes all columns of ``df`` as Parquet, a folder ``shard=n`` for each shard, each in as many
    files as its buckets need."""
    ship(df.sparkSession)
    dealt = df.withColumn("shard", shard_of(F.col(id_col), shards)).withColumn("_bucket", _bucket(F.col(id_col), buckets))
    dealt.repartition("shard", "_bucket").drop("_bucket").write.mode("append").partitionBy("shard").parquet(path)
