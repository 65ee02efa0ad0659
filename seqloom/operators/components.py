"""Connected components of an undirected graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.plans.recovery import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = low.select("u", F.col("m").alias("v"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(moved).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", rounds: int = 100) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node reachable.

    Each round is two aggregations and two equi joins over the edge list; no group of
    neighbours is ever collected.  Self loops and null ends are dropped; without edges
    the result is empty.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v").distinct()
    e = cut(e)
    mark = None
    for _ in range(rounds):
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now[0] == 0 or now == mark:
            break
        mark = now
        e = cut(_small_star(_large_star(e)))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
