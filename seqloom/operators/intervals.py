"""Closed integer intervals (keys, beg, end): merging, coverage, containment, overlap joins and sweeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.plans.scan import Scan


def merged(df: DataFrame, keys: list[str], touch: int = 0) -> DataFrame:
    """(keys, beg, end, n, len): unions of intervals that overlap, with their members' count.

    ``touch`` = 0 joins intervals whose begin is at most the largest end so far; 1 also adjacent ones.
    """
    groups = Scan(df, keys, ["beg", "end"]).reach("__reach", "end")
    groups = groups.with_column("__new", F.when(F.col("beg") <= F.col("__reach") + touch, 0).otherwise(1)).running("__g", "__new", peers=True).table
    out = groups.groupBy(*keys, "__g").agg(F.min("beg").alias("beg"), F.max("end").alias("end"), F.count("*").alias("n")).drop("__g")
    return out.withColumn("len", F.col("end") - F.col("beg") + 1)


def union_length(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, covered): how many positions the intervals of a key cover."""
    by = Window.partitionBy(*keys).orderBy("beg", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(by), F.col("beg") - 1)
    own = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("beg") - 1, reach))
    return df.withColumn("__own", own).groupBy(*keys).agg(F.sum("__own").alias("covered"))


def contained(df: DataFrame, keys: list[str], tie: list[str]) -> DataFrame:
    """Distinct intervals that lie in an earlier or longer one, with how far intervals before them reach."""
    by = Window.partitionBy(*keys).orderBy("beg", F.desc("end"), *tie).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("reach", F.max("end").over(by)).where(F.col("end") <= F.col("reach"))


def partial_overlaps(df: DataFrame, keys: list[str], tie: list[str]) -> DataFrame:
    """Neighbours that overlap in part once contained intervals are gone: (keys, beg, end, next_beg, overlap)."""
    order = Window.partitionBy(*keys).orderBy("beg", F.desc("end"), *tie)
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rest = df.withColumn("__r", reach).where(F.col("__r").isNull() | (F.col("end") > F.col("__r")))
    nxt = F.lead("beg").over(Window.partitionBy(*keys).orderBy("beg", "end"))
    return rest.withColumn("next_beg", nxt).where(F.col("next_beg") <= F.col("end")).select(*keys, "beg", "end", "next_beg", (F.col("end") - F.col("next_beg") + 1).alias("overlap"))


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Pairs of intervals of ``a`` and ``b`` (columns suffixed _a, _b) that share a position.

    Both sides are cut into bins of ``size`` and meet by (keys, bin); a pair counts in the
    bin where the later of the two begins, so it comes out once.
    """

    def binned(df: DataFrame, x: str) -> DataFrame:
        named = df.select(*keys, *[F.col(c).alias(f"{c}_{x}") for c in df.columns if c not in keys])
        return named.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(f"beg_{x}") / size), F.floor(F.col(f"end_{x}") / size))))

    pairs = binned(a, "a").join(binned(b, "b"), [*keys, "__bin"])
    pairs = pairs.where("beg_a <= end_b AND beg_b <= end_a")
    return pairs.where(F.col("__bin") == F.floor(F.greatest("beg_a", "beg_b") / size)).drop("__bin")


def containment_join(inner: DataFrame, outer: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Pairs of which the first lies within the second."""
    return overlap_join(inner, outer, keys, size).where("beg_a >= beg_b AND end_a <= end_b")


def depth(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, beg, end, depth): maximal segments of constant positive depth, by a sweep over begin and end events."""
    events = df.select(*keys, F.col("beg").alias("at"), F.lit(1).alias("d")).unionByName(df.select(*keys, (F.col("end") + 1).alias("at"), F.lit(-1).alias("d")))
    events = events.groupBy(*keys, "at").agg(F.sum("d").alias("d")).where("d <> 0")
    swept = Scan(events, keys, ["at"]).after(__next="at").running("depth", "d").table
    swept = swept.select(*keys, F.col("at").alias("beg"), (F.col("__next") - 1).alias("end"), "depth")
    return swept.where("depth > 0")


def intersection(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, beg, end): segments that both sets cover, by one sweep over the union of their events."""
    ua, ub = merged(a, keys, 1).select(*keys, "beg", "end"), merged(b, keys, 1).select(*keys, "beg", "end")
    both = depth(ua.unionByName(ub), keys).where("depth = 2")
    return both.select(*keys, "beg", "end")


def nearest(points: DataFrame, df: DataFrame, keys: list[str], at: str = "at") -> DataFrame:
    """``points`` (keys, at) with before (largest end below) and after (smallest begin above): an as-of join both ways."""
    p = points.select(*keys, F.col(at).alias("at"), F.lit(1).alias("k"), F.lit(None).cast("long").alias("e"), F.lit(None).cast("long").alias("b"))
    ends = df.select(*keys, F.col("end").alias("at"), F.lit(2).alias("k"), F.col("end").alias("e"), F.lit(None).cast("long").alias("b"))
    begs = df.select(*keys, F.col("beg").alias("at"), F.lit(0).alias("k"), F.lit(None).cast("long").alias("e"), F.col("beg").alias("b"))
    both = p.unionByName(ends).unionByName(begs)
    # The begins ascend, so the next one is the smallest above.
    both = Scan(both, keys, ["at", "k"]).reach("before", "e").next("after", "b").table
    return both.where("k = 1").select(*keys, "at", "before", "after")


def expanded_axis(df: DataFrame, keys: list[str], gain: str, pos: str = "beg") -> DataFrame:
    """``df`` with shift (columns gained before each row) and new_pos on the axis that holds the gains."""
    by = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum(gain).over(by), F.lit(0))
    return df.withColumn("shift", shift).withColumn("new_pos", F.col(pos) + F.col("shift"))


def grid(df: DataFrame, size: int) -> DataFrame:
    """Intervals longer than ``size`` cut into equal parts: (.., beg, end) of each part."""
    n = F.ceil((F.col("end") - F.col("beg") + 1) / size)
    cut = df.withColumn("__n", n).withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    length = F.col("end") - F.col("beg") + 1
    lo = F.col("beg") + F.floor(length * F.col("__k") / F.col("__n"))
    hi = F.col("beg") + F.floor(length * (F.col("__k") + 1) / F.col("__n")) - 1
    rest = [c for c in df.columns if c not in ("beg", "end")]
    return cut.select(*rest, lo.alias("beg"), hi.alias("end"))
