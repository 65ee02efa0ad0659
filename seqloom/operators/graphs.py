"""Directed graphs (src, dst): shortcuts, dominance, condensation, peeling and attribution of nodes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.components import connected_components
from seqloom.plans.groups import small_or_keyed, solve
from seqloom.plans.recovery import cut, table


def component_sizes(edges: DataFrame) -> DataFrame:
    """(component, n) of the weakly connected components."""
    return connected_components(edges).groupBy("component").agg(F.count("*").alias("n"))


def shortcuts(edges: DataFrame) -> DataFrame:
    """Edges i -> k that a path i -> j -> k over other edges replaces."""
    two = edges.alias("a").join(edges.alias("b"), F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst"))
    return edges.join(two, ["src", "dst"], "left_semi")


def without_shortcuts(edges: DataFrame) -> DataFrame:
    return edges.join(shortcuts(edges), ["src", "dst"], "left_anti")


def degrees(edges: DataFrame) -> DataFrame:
    """(node, n_in, n_out)"""
    both = edges.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(edges.select(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    return both.groupBy("node").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))


def condensed(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(src, dst, n, n_src, n_dst): links between the groups of ``nodes`` (name, node), with distinct ends; no loops."""
    a = edges.join(nodes.select(F.col("name").alias("src"), F.col("node").alias("a")), "src")
    b = a.join(nodes.select(F.col("name").alias("dst"), F.col("node").alias("b")), "dst").where("a <> b")
    return b.groupBy("a", "b").agg(F.count("*").alias("n"), F.count_distinct("src").alias("n_src"), F.count_distinct("dst").alias("n_dst")).select(F.col("a").alias("src"), F.col("b").alias("dst"), "n", "n_src", "n_dst")


def dominant(edges: DataFrame, nodes: DataFrame, share: float = 0.7) -> DataFrame:
    """Links between groups that at least ``share`` of either group's members take part in."""
    sizes = nodes.groupBy("node").agg(F.count("*").alias("size"))
    c = condensed(edges, nodes)
    c = c.join(sizes.select(F.col("node").alias("src"), F.col("size").alias("s")), "src").join(sizes.select(F.col("node").alias("dst"), F.col("size").alias("t")), "dst")
    return c.where((F.col("n_src") / F.col("s") >= share) & (F.col("n_dst") / F.col("t") >= share)).select("src", "dst", "n", "n_src", "n_dst")


def _reach(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(node, label): the least label of the seeds (node, label) that reaches each node along the edges."""
    best, last = cut(seeds), None
    while True:
        moved = edges.join(best.withColumnRenamed("node", "src"), "src").select(F.col("dst").alias("node"), "label")
        best = cut(best.unionByName(moved).groupBy("node").agg(F.min("label").alias("label")))
        mark = tuple(best.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "label"))).first())
        if mark == last:
            return best
        last = mark


def tarjan(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """Each node's strongly connected component, named by its smallest member, in one process."""
    near: dict[int, list[int]] = {}
    for a, b in pairs:
        near.setdefault(a, []).append(b)
        near.setdefault(b, [])
    index: dict[int, int] = {}
    low: dict[int, int] = {}
    out: dict[int, int] = {}
    path: list[int] = []
    for root in near:
        if root in index:
            continue
        index[root] = low[root] = len(index)
        path.append(root)
        work = [(root, iter(near[root]))]
        while work:
            v, rest = work[-1]
            for w in rest:
                if w not in index:
                    index[w] = low[w] = len(index)
                    path.append(w)
                    work.append((w, iter(near[w])))
                    break
                if w not in out:
                    low[v] = min(low[v], index[w])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[v])
                if low[v] == index[v]:
                    at = path.index(v) if len(path) < 64 else len(path) - 1 - path[::-1].index(v)
                    members = path[at:]
                    del path[at:]
                    out.update(dict.fromkeys(members, min(members)))
    return out


def strong_components(edges: DataFrame, small: int = 200_000) -> DataFrame:
    """(name, node): each node's strongly connected component, named by its smallest member.

    A weakly connected part with up to ``small`` edges is solved in one task; larger ones by
    ``strong_components_by_cycles``.
    """
    e = cut(edges.select("src", "dst").where("src <> dst").distinct())
    tagged = e.join(connected_components(e).select(F.col("node").alias("src"), "component"), "src")
    sizes = small_or_keyed(cut(tagged.groupBy("component").agg(F.count("*").alias("n"))))
    tagged = cut(tagged.join(sizes, "component"))
    near = tagged.where(F.col("n") <= small).select("component", "src", "dst")
    found = solve(near, ["component"], lambda key, rows: tarjan(rows).items(), "name long, node long")
    large = tagged.where(F.col("n") > small).select("src", "dst")
    return found.unionByName(strong_components_by_cycles(large, small)) if large.limit(1).count() else found


def _orbits(step: DataFrame) -> DataFrame:
    """(node, root, depth) of a function (node, to): the least node of the cycle that each node runs into, and the steps until there (0 on it).

    Pointers double: after k rounds they lie 2^k steps ahead, so rounds grow with the logarithm of the longest path.
    Each round is written and read as a table: what the planner infers about a checkpoint would double from round to round.
    """
    jump, mark = table(step.select("node", "to", F.col("to").alias("low")), "orbits"), None
    while True:
        # Where as many nodes are pointed at as a round before, these are the cycles; where their lows stay, each covers its cycle.
        cycle = jump.select(F.col("to").alias("node")).distinct()
        on = table(jump.join(cycle, "node", "left_semi").select("node", "low"), "orbits")
        now = tuple(on.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "low"))).first())
        if now == mark:
            break
        mark = now
        far = jump.select(F.col("node").alias("to"), F.col("to").alias("__to"), F.col("low").alias("__low"))
        jump = table(jump.join(far, "to").select("node", F.col("__to").alias("to"), F.least("low", "__low").alias("low")), "orbits")
    tree = step.join(on, "node", "left")
    walk = table(tree.select("node", F.when(F.col("low").isNull(), F.col("to")).otherwise(F.col("node")).alias("to"), F.col("low").isNull().cast("long").alias("depth")), "orbits")
    while True:
        far = walk.select(F.col("node").alias("to"), F.col("to").alias("__to"), F.col("depth").alias("__depth"))
        ahead = walk.join(far, "to").select("node", F.col("__to").alias("to"), (F.col("depth") + F.col("__depth")).alias("depth"), "__depth")
        walk = table(ahead, "orbits")
        if not walk.where("__depth > 0").limit(1).count():
            break
        walk = walk.drop("__depth")
    return walk.join(on.select(F.col("node").alias("to"), F.col("low").alias("root")), "to").select("node", "root", "depth")


def strong_components_by_cycles(edges: DataFrame, small: int = 200_000) -> DataFrame:
    """The same for graphs of any size: cycles are found by pointer doubling and contracted, then only what may still be on a cycle goes on.

    Each node takes one way out, one that no path of two replaces where it has such a way.  The cycles of these ways become
    one node each.  A cycle that is left has an edge that does not come nearer to the end of its ways, and no node farther from
    there than the heads of such edges: only these nodes are searched again.  Without a contraction
    ``strong_components_by_colour`` takes over.
    """
    left = cut(edges.where("src <> dst").distinct())
    nodes = left.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    # Which way is taken decides on the rounds only, so paths through nodes of many ways need not be known.
    few = left.groupBy("src").count().where("count <= 16").select("src")
    paths = left.alias("a").join(left.join(few, "src", "left_semi").alias("b"), F.col("a.dst") == F.col("b.src")).select("a.src", "b.dst").distinct()
    ways = left.join(paths.withColumn("short", F.lit(1)), ["src", "dst"], "left").groupBy(F.col("src").alias("node")).agg(F.min(F.struct(F.coalesce("short", F.lit(0)), "dst"))["dst"].alias("to"))
    orbits = table(_orbits(table(nodes.join(ways, "node", "left").select("node", F.coalesce("to", "node").alias("to")), "orbits")), "orbits")
    at = lambda end: orbits.select(F.col("node").alias(end), F.when(F.col("depth") == 0, F.col("root")).otherwise(F.col("node")).alias(f"{end}_node"), F.col("root").alias(f"{end}_root"), F.col("depth").alias(f"{end}_depth"))
    moved = cut(left.join(at("src"), "src").join(at("dst"), "dst").where("src_node <> dst_node"))
    rising = moved.where("src_root <> dst_root OR dst_depth >= src_depth")
    bound = cut(rising.groupBy(F.col("dst_root").alias("root")).agg(F.max("dst_depth").alias("most")))
    names = orbits.select(F.col("node").alias("name"), F.when(F.col("depth") == 0, F.col("root")).otherwise(F.col("node")).alias("node"))
    for end in ("src", "dst"):
        held = small_or_keyed(bound.select(F.col("root").alias(f"{end}_root"), F.col("most").alias(f"{end}_most")))
        moved = moved.join(held, f"{end}_root").where(F.col(f"{end}_depth") <= F.col(f"{end}_most"))
    rest = cut(moved.select(F.col("src_node").alias("src"), F.col("dst_node").alias("dst")).distinct())
    if not rest.limit(1).count():
        return names
    again = names.where("name <> node").limit(1).count() or rest.count() < left.count()
    found = strong_components(rest, small) if again else strong_components_by_colour(rest)
    return names.join(found.select(F.col("name").alias("node"), F.col("node").alias("__n")), "node", "left").select("name", F.coalesce("__n", "node").alias("node"))


def strong_components_by_colour(edges: DataFrame) -> DataFrame:
    """The same for graphs of any size.

    Rounds of trimming (nodes without a way in or out are alone) and colouring: labels flow
    forward from every node, then backward from each colour's root within the colour.
    Every step is a join and an aggregation over the edges that are left.
    """
    left = cut(edges.where("src <> dst").distinct())
    names = left.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    done: list[DataFrame] = []
    while left.limit(1).count():
        while True:
            live = left.select("src").join(left.select(F.col("dst").alias("src")), "src", "left_semi").distinct()
            kept = left.join(live, "src", "left_semi").join(live.select(F.col("src").alias("dst")), "dst", "left_semi").select("src", "dst")
            kept = cut(kept)
            if kept.count() == left.count():
                break
            left = kept
        if not left.limit(1).count():
            break
        nodes = left.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        colour = _reach(left, nodes.withColumn("label", F.col("node")))
        tinted = left.join(colour.select(F.col("node").alias("src"), F.col("label").alias("c")), "src").join(colour.select(F.col("node").alias("dst"), F.col("label").alias("k")), "dst")
        same = cut(tinted.where("c = k").select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        roots = colour.where("node = label")
        back = _reach(same, roots)
        found = cut(back.select(F.col("node").alias("name"), F.col("label").alias("node")))
        done.append(found)
        gone = found.select("name")
        left = cut(left.join(gone, left.src == gone.name, "left_anti").join(gone, left.dst == gone.name, "left_anti"))
    out = names.withColumn("node", F.col("name"))
    for found in done:
        out = out.join(found.withColumnRenamed("node", "__n"), "name", "left").select("name", F.coalesce("__n", "node").alias("node"))
    return out


def peeled(edges: DataFrame) -> DataFrame:
    """(src, dst, round): 0 for edges of the core; otherwise the round in which a node without other neighbours left."""
    left, gone, k = cut(edges.where("src <> dst").distinct()), None, 0
    while True:
        k += 1
        pairs = left.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
        n = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n")).where("n = 1").select("node")
        out = left.join(n, left.src == n.node, "left_semi").unionByName(left.join(n, left.dst == n.node, "left_semi")).distinct()
        out = cut(out.withColumn("round", F.lit(k)))
        if not out.limit(1).count():
            break
        gone = out if gone is None else gone.unionByName(out)
        left = cut(left.join(out, ["src", "dst"], "left_anti"))
    core = left.withColumn("round", F.lit(0))
    return core if gone is None else core.unionByName(gone)


def attributed(edges: DataFrame, known: DataFrame, share: float = 0.7) -> DataFrame:
    """(node, component): ``known`` (node, component) and the nodes that give ``share`` or more of their links to one component, in turn."""
    known = cut(known.select("node", "component"))
    both = cut(edges.select(F.col("src").alias("node"), F.col("dst").alias("to")).unionByName(edges.select(F.col("dst").alias("node"), F.col("src").alias("to"))).distinct())
    total = both.groupBy("node").agg(F.count("*").alias("all"))
    while True:
        near = both.join(known, "node", "left_anti").join(known.select(F.col("node").alias("to"), "component"), "to")
        n = near.groupBy("node", "component").agg(F.count("*").alias("n")).join(total, "node")
        best = n.where(F.col("n") / F.col("all") >= share)
        best = cut(best.groupBy("node").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("component")))
        if not best.limit(1).count():
            return known
        known = cut(known.unionByName(best))


def without_small(edges: DataFrame, least: int) -> DataFrame:
    """Edges of weak components with ``least`` nodes or more."""
    c = connected_components(edges)
    big = c.withColumn("n", F.count("*").over(Window.partitionBy("component"))).where(F.col("n") >= least)
    return edges.join(big.select(F.col("node").alias("src")), "src", "left_semi")


def bridges(edges: DataFrame) -> DataFrame:
    """(src, dst) of undirected links whose removal cuts a component; a component is searched in one task."""
    und = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).where("src <> dst").distinct()
    tagged = und.join(connected_components(und).select(F.col("node").alias("src"), "component"), "src")

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        near: dict[int, list[int]] = {}
        for a, b in zip(pdf.src.tolist(), pdf.dst.tolist(), strict=True):
            near.setdefault(a, []).append(b)
            near.setdefault(b, []).append(a)
        seen, low, out, clock = {}, {}, [], 0
        root = min(near)
        stack = [(root, None, iter(near[root]))]
        seen[root] = low[root] = clock
        while stack:
            v, parent, it = stack[-1]
            for w in it:
                if w not in seen:
                    clock += 1
                    seen[w] = low[w] = clock
                    stack.append((w, v, iter(near[w])))
                    break
                if w != parent:
                    low[v] = min(low[v], seen[w])
            else:
                stack.pop()
                if parent is not None:
                    low[parent] = min(low[parent], low[v])
                    if low[v] > seen[parent]:
                        out.append((min(v, parent), max(v, parent)))
        return pd.DataFrame(out, columns=["src", "dst"])

    return tagged.select("src", "dst", "component").groupBy("component").applyInPandas(kernel, "src long, dst long")


def between_communities(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """``edges`` without those whose ends are in different communities of ``groups`` (node, community), or in none."""
    g = groups.select(F.col("node").alias("src"), F.col("community").alias("__a"))
    h = groups.select(F.col("node").alias("dst"), F.col("community").alias("__b"))
    return edges.join(g, "src").join(h, "dst").where("__a = __b").select(*edges.columns)


def within_cycles(edges: DataFrame) -> DataFrame:
    """``edges`` whose ends both have a link that is no bridge."""
    cuts = bridges(edges).select(F.col("src").alias("a"), F.col("dst").alias("b"))
    und = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).where("a <> b").distinct()
    held = und.join(cuts, ["a", "b"], "left_anti").select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return edges.join(held.withColumnRenamed("node", "src"), "src", "left_semi").join(held.withColumnRenamed("node", "dst"), "dst", "left_semi").select(*edges.columns)


def without_singletons(edges: DataFrame) -> DataFrame:
    """``edges`` that begin at a node of a link that stands in both directions."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")).distinct()
    held = edges.join(back, ["src", "dst"], "left_semi").select(F.explode(F.array("src", "dst")).alias("src")).distinct()
    return edges.join(held, "src", "left_semi").select(*edges.columns)


def filtered_edges(edges: DataFrame, least: int | None = None, groups: DataFrame | None = None, cycles: bool = False, paired: bool = False) -> DataFrame:
    """The filters of a graph in their order: components of ``least`` nodes, links within communities, nodes on cycles, nodes of links in both directions."""
    if least is not None:
        edges = without_small(edges, least)
    if groups is not None:
        edges = between_communities(edges, groups)
    if cycles:
        edges = within_cycles(cut(edges))
    return without_singletons(cut(edges)) if paired else edges


def communities(edges: DataFrame) -> DataFrame:
    """(node, community) by label propagation: each node takes its neighbours' most frequent label, ties to the smaller.

    A deterministic stand-in for randomised modularity search.  All nodes move at once, until a round repeats the labels of
    an earlier one; where that was not the round before, each node gets the smallest of its labels since.
    """
    both = cut(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct())
    labels = cut(both.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node")))
    states: list[DataFrame] = []
    marks: list[tuple] = []
    while True:
        mark = tuple(labels.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "community")), F.sum(F.pmod(F.xxhash64("community", "node"), F.lit(1 << 40)))).first())
        if mark in marks:
            break
        marks.append(mark)
        states.append(labels)
        votes = both.join(labels.select(F.col("node").alias("dst"), "community"), "dst").unionByName(labels.select(F.lit(None).cast("long").alias("dst"), F.col("node").alias("src"), "community"))
        n = votes.groupBy("src", "community").agg(F.count("*").alias("n"))
        labels = cut(n.groupBy("src").agg(F.max_by("community", F.struct("n", -F.col("community"))).alias("community")).select(F.col("src").alias("node"), "community"))
    for state in states[marks.index(mark) + 1 :]:
        labels = labels.unionByName(state)
    return labels.groupBy("node").agg(F.min("community").alias("community"))


def families(edges: DataFrame, least: int = 3, share: float = 0.7) -> DataFrame:
    """(node, component): shortcuts fall, small components fall, and what was dropped is attributed back."""
    # Each is read several times.
    edges = table(edges.select("src", "dst"), "edges")
    core = table(without_small(table(without_shortcuts(edges), "edges"), least), "edges")
    return attributed(edges, connected_components(core), share)
