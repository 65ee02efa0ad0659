"""Shared pieces of the text operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.plans.recovery import table

#: A word is a maximal run of characters other than these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def packed(docs: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of ``docs`` as one, so that no name of theirs meets a name of the operator; ``row.*`` takes them out."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without])


def if_small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` with a hint to broadcast it if it has at most ``most`` rows; a larger one is joined by its keys."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, uid, text): ``uid`` is unique and follows the id; nulls come last, rows of one id in an order that their texts decide."""
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    ids = docs.agg(F.count("*").alias("n"), F.countDistinct(doc_id).alias("u")).first()
    if ids.n == ids.u:
        return docs.select(packed(docs).alias("row"), doc_id.alias("uid"), text.alias("text"))
    order = [doc_id.asc_nulls_last(), F.xxhash64(text)]  # the hash parts the rows of one id
    ranged = docs.repartitionByRange(max(1, docs.rdd.getNumPartitions()), *order).sortWithinPartitions(*order, text)
    return table(ranged.select(packed(docs).alias("row"), F.monotonically_increasing_id().alias("uid"), text.alias("text")), "numbered")


def text_of(value: str | None) -> bytes:
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def give_back() -> None:
    """Return what a kernel no longer needs to the system: workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sliced(batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose column ``column`` holds about ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        if not len(sizes):
            continue
        part = (np.cumsum(sizes) - sizes) // limit
        at = np.flatnonzero(np.diff(part, prepend=-1))
        for lo, hi in zip(at, [*at[1:], len(sizes)], strict=True):
            yield batch.slice(lo, hi - lo)
    batch = None
    give_back()


def sorted_groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Rows that come sorted by column ``key``, as one table for each value; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        at = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            if held and keys[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = keys[lo]
    if held:
        yield pa.Table.from_batches(held)
    held = batch = None
    give_back()
