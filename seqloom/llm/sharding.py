"""Sharding by jump consistent hashing (law ``key``), with gapless slots from prefix sums."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.plans.recovery import cut


def mix(keys: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: neighbouring keys become unrelated 64-bit values."""
    z = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key: with one more shard, a key stays or moves into it."""
    state, bucket, nxt = keys.astype(np.uint64), np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    while (live := nxt < shards).any():
        bucket[live] = nxt[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        nxt[live] = ((bucket[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
    return bucket


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long column; null keys count as key 0, and equal keys share a shard."""

    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(mix(keys.to_numpy().astype(np.int64)), shards).astype(np.int32))

    return of(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard), one row for each row of ``docs``.

    The id and the number of shards alone decide; repeated ids share a shard and get slots
    of their own.  Slots count from 0 in ascending doc_id (nulls first, then by size and
    crc32), from each range's count before it: no shard is ever gathered in one task.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    ranges = max(1, docs.rdd.getNumPartitions())
    rows = cut(rows.repartitionByRange(ranges, "doc_id").withColumn("range", F.spark_partition_id()))
    rows = rows.withColumns({"shard": shard_of(F.col("doc_id"), shards), "grown_shard": shard_of(F.col("doc_id"), shards + 1)})
    # One row for each range and shard: its size follows the number of partitions, not of rows.
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("range", "shard").count().select("range", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("range", "shard").orderBy("doc_id", "size", "text_crc32")
    placed = rows.withColumn("at", F.row_number().over(own)).join(bases, ["range", "shard"])
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("at") - 1).alias("slot"), "grown_shard")


def query(docs: DataFrame) -> DataFrame:
    return assign(docs).withColumn("law", F.lit("key"))
