"""Windows along axes of any length: ranges of an axis are scanned on their own, and one row a range carries the state on.

A table whose plan gives it at most ``SMALL`` bytes, or that turns out to have at most ``ROWS`` rows, is scanned with one range a
key, which needs no written table.  A larger one is dealt to ranges of its keys and order, written once, and no task sorts more than a range.
Either has more tasks as its files or rows grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seqloom.plans.groups import dealt, small_or_keyed
from seqloom.plans.recovery import cut

SMALL, ROWS = 1 << 30, 4_000_000
#: Rows of a task where they have been counted.
TASK = 500_000
RANGE = "__range"


def measured(df: DataFrame) -> tuple[DataFrame, bool, int | None]:
    """``df``, whether one task may not be able to sort it, and tasks for its rows if they were counted.

    The optimizer's size of a table is too large where it cannot tell, so it is written and its rows decide then.
    """
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= SMALL:
        return df, False, None
    held = cut(df)
    n = held.count()
    return held, n > ROWS, n // TASK


class Scan:
    """Columns along ``order`` within ``keys``; each step adds some and gives the scan back, ``table`` gives the rows.

    Rows of one key and order stand in any order among themselves.  Null keys are keys of their own.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str | Column], split: bool | None = None) -> None:
        self.keys = keys
        self.order = [F.col(c) if isinstance(c, str) else c for c in order]
        df, self.split, shares = measured(df) if split is None else (df, split, None)
        if self.split:
            ranged = df.repartitionByRange(shares, *keys, *self.order) if shares else df.repartitionByRange(*keys, *self.order)
            self.df = dealt(cut(ranged.withColumn(RANGE, F.spark_partition_id())), *keys, RANGE, shares=shares or 0)
        else:
            self.df = dealt(df, *keys, shares=shares).withColumn(RANGE, F.lit(0))
        self.by = Window.partitionBy(*keys, RANGE).orderBy(*self.order)
        self.back = Window.partitionBy(*keys, RANGE).orderBy(*[c.desc() for c in self.order])

    def _ranges(self, *aggregates: Column) -> DataFrame:
        return self.df.groupBy(*self.keys, RANGE).agg(*aggregates)

    def _carried(self, ranges: DataFrame, values: dict[str, Column]) -> None:
        """Add what the ranges before (or after) a row's range leave; ``values`` are over a window of ranges."""
        named = ranges.withColumns(values).select(*[F.col(k).alias(f"__of_{k}") for k in [*self.keys, RANGE]], *values)
        same = F.lit(True)
        for k in [*self.keys, RANGE]:
            same &= self.df[k].eqNullSafe(F.col(f"__of_{k}"))
        self.df = self.df.join(small_or_keyed(named), same, "left").drop(*[f"__of_{k}" for k in [*self.keys, RANGE]])

    def _along(self):
        """The ranges of a key in order: one row a range."""
        return Window.partitionBy(*self.keys).orderBy(RANGE)

    def with_column(self, name: str, value: Column) -> Scan:
        self.df = self.df.withColumn(name, value)
        return self

    def number(self, name: str) -> Scan:
        """Rows numbered from 1."""
        self.df = self.df.withColumn("__one", F.lit(1).cast("long"))
        self.running(name, "__one")
        self.df = self.df.drop("__one")
        return self

    def running(self, name: str, column: str, peers: bool = False) -> Scan:
        """The sum of ``column`` up to and with each row; nulls count as 0.

        With ``peers`` rows of one key and order share the sum with all of them: a sort after a step may turn such rows, so a mark that
        only the first of them carries would come late for others.
        """
        frame = self.by.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers else self.by.rowsBetween(Window.unboundedPreceding, 0)
        value = F.coalesce(F.sum(column).over(frame), F.lit(0))
        if self.split:
            before = self._along().rowsBetween(Window.unboundedPreceding, -1)
            self._carried(self._ranges(F.sum(column).alias("__s")), {"__base": F.coalesce(F.sum("__s").over(before), F.lit(0))})
            value = value + F.col("__base")
        self.df = self.df.withColumn(name, value).drop("__base")
        return self

    def reach(self, name: str, column: str) -> Scan:
        """The largest ``column`` of the rows before; null without one."""
        value = F.max(column).over(self.by.rowsBetween(Window.unboundedPreceding, -1))
        if self.split:
            before = self._along().rowsBetween(Window.unboundedPreceding, -1)
            self._carried(self._ranges(F.max(column).alias("__m")), {"__base": F.max("__m").over(before)})
            value = F.greatest(value, F.col("__base"))
        self.df = self.df.withColumn(name, value).drop("__base")
        return self

    def last(self, name: str, column: str) -> Scan:
        """The last ``column`` that is not null of the rows before; null without one."""
        return self._known(name, column, F.last, F.max_by, (Window.unboundedPreceding, -1), self.by)

    def next(self, name: str, column: str) -> Scan:
        """The first ``column`` that is not null of the rows after; null without one.

        Rows are read backwards: a frame that ends with the last row would be read anew for each row.
        """
        return self._known(name, column, F.first, F.min_by, (1, Window.unboundedFollowing), self.back)

    def _known(self, name: str, column: str, pick, end, frame: tuple[int, int], by: WindowSpec) -> Scan:
        value = F.last(column, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
        if self.split:
            edge = end(F.col(column), F.when(F.col(column).isNotNull(), F.struct(*self.order)))
            self._carried(self._ranges(edge.alias("__e")), {"__base": pick("__e", ignorenulls=True).over(self._along().rowsBetween(*frame))})
            value = F.coalesce(value, F.col("__base"))
        self.df = self.df.withColumn(name, value).drop("__base")
        return self

    def before(self, **columns: str) -> Scan:
        """Each new column is the named one of the row before; null in the first row."""
        return self._next(F.lag, F.max_by, F.lag, F.row_number().over(self.by) == 1, columns)

    def after(self, **columns: str) -> Scan:
        """Each new column is the named one of the row after; null in the last row."""
        return self._next(F.lead, F.min_by, F.lead, F.lead(F.lit(1)).over(self.by).isNull(), columns)

    def _next(self, near, end, along, outer: Column, columns: dict[str, str]) -> Scan:
        local = {new: near(c).over(self.by) for new, c in columns.items()}
        if self.split:
            held = F.struct(*[F.col(c).alias(new) for new, c in columns.items()])
            self._carried(self._ranges(end(held, F.struct(*self.order)).alias("__e")), {"__base": along("__e").over(self._along())})
            local = {new: F.when(outer, F.col(f"__base.{new}")).otherwise(c) for new, c in local.items()}
        self.df = self.df.withColumns(local).drop("__base")
        return self

    @property
    def table(self) -> DataFrame:
        return self.df.drop(RANGE)
