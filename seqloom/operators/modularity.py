"""Communities of an undirected graph by modularity: local moves by gain, then condensation, level by level.

With A the symmetric weights, k the weighted degrees and M their sum, the score of a partition is M times the weight
inside its communities less the squares of their volumes; modularity is the score over M squared.  Scores are whole
numbers (decimals), so a run gives the same communities each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.plans.recovery import table


def cut(df: DataFrame) -> DataFrame:
    """A written table: a checkpoint keeps what the optimizer inferred of its columns, which doubles from round to round here."""
    return table(df, "modularity")


def keyed(df: DataFrame) -> DataFrame:
    """``df`` to be joined by its keys, however small it is: there is a table for each round, and broadcast ones would all pass the driver."""
    return df.hint("merge")


def _exact(c: Column | str) -> Column:
    return F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")


def _weights(edges: DataFrame) -> DataFrame:
    """(u, v, w) in both directions: how many rows of ``edges`` link a pair; loops and null ends are dropped."""
    e = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).where("u <> v")
    return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u", "v").agg(F.count("*").alias("w"))


def modularity(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """One row (modularity): of the partition ``groups`` (node, community) of all nodes of ``edges``; null without edges."""
    links = _weights(edges)
    g = groups.select("node", "community")
    inner = links.join(g.toDF("u", "a"), "u").join(g.toDF("v", "b"), "v").agg(F.sum("w").alias("m"), F.sum(F.when(F.col("a") == F.col("b"), F.col("w")).otherwise(0)).alias("inner"))
    volume = links.groupBy("u").agg(F.sum("w").alias("k")).join(g.toDF("u", "a"), "u").groupBy("a").agg(F.sum("k").alias("vol"))
    squares = volume.agg(F.sum(_exact("vol") * _exact("vol")).alias("squares"))
    m = _exact("m")
    return inner.join(squares).select(((m * _exact("inner") - F.col("squares")).cast("double") / (m * m).cast("double")).alias("modularity"))


class _Level:
    """One level: ``links`` (u, v, w), ``nodes`` (node, loop, k) and the label of each node."""

    def __init__(self, links: DataFrame, nodes: DataFrame, total: int) -> None:
        self.links, self.nodes, self.total = links, nodes, total
        self.loops = nodes.agg(F.sum("loop")).first()[0]
        self.labels = nodes.select("node", F.col("node").alias("label"), "k")
        self.near, self.volumes, self.score = self._seen(self.labels)

    def _seen(self, labels: DataFrame) -> tuple[DataFrame, DataFrame, int]:
        """(node, label, k, c, w), the weight of each node's links to each community; (label, vol, size); and the score."""
        w = self.links.join(keyed(labels.select(F.col("node").alias("v"), F.col("label").alias("c"))), "v").groupBy(F.col("u").alias("node"), "c").agg(F.sum("w").alias("w"))
        near = cut(labels.join(keyed(w), "node"))
        inner = near.agg(F.sum(F.when(F.col("c") == F.col("label"), F.col("w")).otherwise(0))).first()[0] or 0
        volumes = labels.groupBy("label").agg(F.sum("k").alias("vol"), F.count("*").alias("size"))
        squares = volumes.agg(F.sum(_exact("vol") * _exact("vol"))).first()[0]
        return near, keyed(volumes), self.total * (inner + self.loops) - int(squares or 0)

    def _moved(self, turn: int) -> DataFrame:
        """(node, label, k) after one half of the nodes took the community of most gain (ties: the smaller label).

        A node that is alone joins another such node only if that one's label is smaller, so no two of them change places.
        """
        held = self.volumes
        movers = self.near.where(F.pmod(F.xxhash64("node", F.lit(turn // 2).cast("long")), F.lit(2)) == turn % 2)
        rows = movers.join(held.select(F.col("label").alias("c"), F.col("vol").alias("c_vol"), F.col("size").alias("c_size")).hint("merge"), "c")
        m, k, own = F.lit(self.total), _exact("k"), F.col("c") == F.col("label")
        rows = rows.withColumn("value", _exact(m) * _exact("w") - k * _exact("c_vol"))
        to = F.struct("value", (-F.col("c")).alias("last"))
        best = rows.groupBy("node", "label", "k").agg(
            F.max(F.when(own, F.col("w"))).alias("w_own"),
            F.max(F.when(~own, to)).alias("any"),
            F.max(F.when(~own & ((F.col("c") < F.col("label")) | (F.col("c_size") > 1)), to)).alias("open"),
        )
        best = best.join(held, "label").withColumn("to", F.when(F.col("size") == 1, F.col("open")).otherwise(F.col("any")))
        stay = _exact(m) * _exact(F.coalesce("w_own", F.lit(0))) - k * _exact(F.col("vol") - F.col("k"))
        gains = best.where(F.col("to.value") > stay).select("node", (-F.col("to.last")).alias("new"))
        return cut(self.labels.join(keyed(gains), "node", "left").select("node", F.coalesce("new", "label").alias("label"), "k"))

    def settle(self, least: float) -> None:
        """Rounds in pairs, each half of the nodes once a pair, until a pair raises modularity by under ``least``; a round that does not raise it is taken back."""
        turn = 0
        while True:
            before = self.score
            for _ in range(2):
                labels = self._moved(turn)
                near, volumes, score = self._seen(labels)
                if score > self.score:
                    self.labels, self.near, self.volumes, self.score = labels, near, volumes, score
                turn += 1
            if self.score - before < least * self.total * self.total or self.score == before:
                return

    def condensed(self) -> tuple[DataFrame, DataFrame]:
        """Links between the communities, and these as nodes."""
        between = self.near.groupBy("label", "c").agg(F.sum("w").alias("w"))
        links = cut(between.where("label <> c").select(F.col("label").alias("u"), F.col("c").alias("v"), "w"))
        inner = between.where("label = c").select("label", F.col("w").alias("inner"))
        own = self.labels.join(keyed(self.nodes.select("node", "loop")), "node").groupBy("label").agg(F.sum("loop").alias("loop"), F.sum("k").alias("k"))
        nodes = own.join(keyed(inner), "label", "left").select(F.col("label").alias("node"), (F.col("loop") + F.coalesce("inner", F.lit(0))).alias("loop"), "k")
        return links, cut(nodes)


def modular_communities(edges: DataFrame, least: float = 1e-3) -> DataFrame:
    """(node, community) for every node with an edge; a community is named by its smallest member.

    Rows that link a pair weigh one each, in either direction; loops and null ends are dropped, and without edges the
    result is empty.  A round is three joins by node or community and pre-aggregated sums, and no table
    is broadcast.  Levels end when one raises modularity by under ``least``.
    """
    links = cut(_weights(edges))
    nodes = cut(links.groupBy(F.col("u").alias("node")).agg(F.lit(0).cast("long").alias("loop"), F.sum("w").alias("k")))
    total = nodes.agg(F.sum("k")).first()[0]
    members = nodes.select(F.col("node").alias("name"), "node")
    while total:
        level = _Level(links, nodes, total)
        first = level.score
        level.settle(least)
        if level.score == first:
            break
        members = cut(members.join(keyed(level.labels.select("node", "label")), "node").select("name", F.col("label").alias("node")))
        if level.score - first < least * total * total:
            break
        links, nodes = level.condensed()
    smallest = members.groupBy("node").agg(F.min("name").alias("community"))
    return members.join(keyed(smallest), "node").select(F.col("name").alias("node"), "community")
