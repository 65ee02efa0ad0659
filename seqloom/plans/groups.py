"""Grouped kernels over sorted partitions: many small groups at the cost of one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.plans.recovery import cut

#: Bytes of compressed files that a task of a dealt table stands for; tables of up to ``FEW`` shares are left to the optimizer, and none has over ``MOST`` tasks.
SHARE, FEW, MOST = 8 << 20, 8, 8192

def solve(df: DataFrame, keys: list[str], kernel: Callable[[tuple, list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """Rows that ``kernel(key, rows)`` gives for each group of ``keys``; ``rows`` hold the other columns in order.

    Rows come sorted by the keys and one group is held at a time.  Nulls of a key are one value of it, given as None.
    """
    rest = [c for c in df.columns if c not in keys]
    names, n = [c.split(" ")[0] for c in schema.split(", ")], len(keys)
    whole = [k for k, kind in df.dtypes if kind in ("tinyint", "smallint", "int", "bigint")]
    # Whole numbers would come as floats beside nulls, so nulls travel as 0 with a bit of their own.
    nil = sum((F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))
    filled = [F.coalesce(F.col(k), F.lit(0)).alias(k) if k in whole else F.col(k) for k in keys]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        out: list[tuple] = []
        now: tuple | None = None

        def solved() -> Iterable[tuple]:
            return kernel(tuple(None if now[n] >> i & 1 else k for i, k in enumerate(now[:n])), held)

        def frame() -> pd.DataFrame:
            return pd.DataFrame(out, columns=names, dtype=object if any(None in row for row in out) else None)

        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                key = row[: n + 1]
                if key != now and held:
                    out.extend(solved())
                    held = []
                now = key
                held.append(row[n + 1 :])
            if len(out) >= 8192:
                yield frame()
                out = []
        if held:
            out.extend(solved())
        if out:
            yield frame()

    groups = df.select(*filled, nil.alias("__nil"), *rest)
    tasks = source_bytes(df) // SHARE
    groups = dealt(groups, *keys, shares=tasks) if tasks > FEW else groups.repartition(*keys)
    return groups.sortWithinPartitions(*keys, "__nil").mapInPandas(run, schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[pa.Table]:
    """Rows that come sorted by their first ``keys`` columns, as one table for each key; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last: tuple = ()
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        at = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def gathered(batches: Iterable[pa.RecordBatch], rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` or more, as a batch costs more than some rows: kernels give one for each small group."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as a shuffle has, however few bytes it holds: for work that costs more than its bytes tell."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def source_bytes(df: DataFrame) -> int:
    """How many bytes the files hold that ``df`` is read from, each as often as the plan reads it; written steps count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    of = [leaves.apply(k) for k in range(leaves.size())]
    return sum(int(x.stats().sizeInBytes()) for x in of if not x.nodeName().endswith("RDD"))


def dealt(df: DataFrame, *keys: str, shares: int | None = None) -> DataFrame:
    """``df`` dealt by ``keys`` to one task for each ``SHARE`` bytes of its files, or to ``shares`` tasks, where these are more than a few.

    A shuffle without a number of tasks has as many as there are cores, until a task gets the advisory size, so what a task sorts and holds grows with the input.
    """
    n = source_bytes(df) // SHARE if shares is None else shares
    return df.repartition(min(n, MOST), *keys) if keys and n > FEW else df


def by_group(df: DataFrame, key: str, order: list[str], kernel: Callable[[pa.Table], list], schema: str) -> DataFrame:
    """Columns that ``kernel(rows)`` gives for each group of ``key``, its rows sorted by ``order`` with nulls last; a null key is one group.

    Groups are dealt to all tasks and come one after another in Arrow batches; one group is held at a time.
    """
    held = df.select(F.col(key).isNull().alias("__nil"), F.coalesce(F.col(key), F.lit("0").cast(df.schema[key].dataType)).alias("__key"), *df.columns)
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[pa.Table] = []
        for group in sorted_groups(batches, 2):
            done.append(pa.table(kernel(group), names=names))
            if len(done) == 1024:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
                done = []
        if done:
            yield from pa.concat_tables(done).combine_chunks().to_batches()

    sent = spread(held, "__nil", "__key").sortWithinPartitions("__nil", "__key", *[F.col(c).asc_nulls_last() for c in order])
    return sent.mapInArrow(run, schema)


def pair_blocks(rows: DataFrame, key: str, member: str, size: int = 256) -> DataFrame:
    """``rows`` with (lo, hi, own): each member of a group goes to the pairs of blocks that hold its block.

    Two members of one group meet in exactly one pair of blocks; a pair of blocks holds about
    2 ``size`` members, however large the group is.
    """
    parts = rows.groupBy(key).agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    sent = rows.join(parts, key).withColumn("own", F.pmod(F.xxhash64(member), F.col("parts")).cast("int"))
    sent = sent.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return sent.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "parts")


def row_numbers(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with its rows numbered from 1 by ``order``: ranges are sorted on their own and counted, so no task holds all rows."""
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, here = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    # One row a partition.
    counts = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__base"))
    out = ranged.withColumn("__part", part).join(F.broadcast(base), "__part")
    return out.withColumn(name, F.col("__base") + here + 1).drop("__part", "__base", "__at")


def small_or_keyed(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` with a hint to broadcast it if it has at most ``most`` rows; a larger one is joined by its keys."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def meet(left: DataFrame, right: DataFrame, key: str, frequent: int) -> DataFrame:
    """``left`` joined with ``right`` on ``key``: of a key with over ``frequent`` rows on the right, these are dealt to several tasks and those on the left copied to each."""
    often = right.groupBy(key).count().where(F.col("count") > frequent).select(key, F.ceil(F.col("count") / frequent).cast("int").alias("__parts"))
    often, parts = small_or_keyed(often), F.coalesce("__parts", F.lit(1))
    columns = [c for c in right.columns if c != key]
    b = right.join(often, key, "left").withColumn("__part", F.pmod(F.xxhash64(*columns), parts).cast("int")).drop("__parts")
    a = left.join(often, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return a.join(b, [key, "__part"]).drop("__part")
