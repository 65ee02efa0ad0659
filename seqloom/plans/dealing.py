"""Tasks of about equal estimated cost for items whose costs differ widely."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.plans.recovery import cut


def by_cost(items: DataFrame, cost: str | Column, tasks: int, order: list[str]) -> DataFrame:
    """``items`` with (task, cost): the hardest first, dealt by their running cost to tasks 0 to ``tasks`` - 1.

    A task holds at most twice the mean cost of a task, or one item that is dearer than the mean: such items stand at
    the front, and each ends where a later task begins.  ``order`` tells items of one cost apart; null or negative costs
    count as 0.  Ranges of items are sorted on their own and summed, so no task holds all of them; without items the
    result is empty, and if nothing costs anything, items are dealt by hash.
    """
    cost = F.col(cost) if isinstance(cost, str) else cost
    by = [F.col("cost").desc(), *[F.col(c) for c in order]]
    priced = items.withColumn("cost", F.greatest(F.coalesce(cost.cast("double"), F.lit(0.0)), F.lit(0.0)))
    ranged = cut(priced.repartitionByRange(*by).withColumn("__range", F.spark_partition_id()))
    # One row a range.
    sums = ranged.groupBy("__range").agg(F.sum("cost").alias("__sum"))
    along = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("__range", F.coalesce(F.sum("__sum").over(along), F.lit(0.0)).alias("__base"), F.sum("__sum").over(Window.partitionBy()).alias("__all"))
    here = F.coalesce(F.sum("cost").over(Window.partitionBy("__range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    placed = ranged.withColumn("__here", here).join(F.broadcast(base), "__range")
    task = F.floor((F.col("__base") + F.col("__here")) * tasks / F.col("__all"))
    free = F.pmod(F.xxhash64(*order), F.lit(tasks))
    task = F.when(F.col("__all") > 0, F.least(task, F.lit(tasks - 1))).otherwise(free)
    return placed.withColumn("task", task.cast("int")).drop("__range", "__here", "__base", "__all")
