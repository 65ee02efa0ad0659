"""Families of sequences over nestedness graphs (src, dst): traits, edge tests by flanks, orientation, merging of hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.functions.sequence import rev_compl
from seqloom.operators import graphs as gr
from seqloom.operators import orfs as of
from seqloom.operators.intervals import contained
from seqloom.plans.groups import gathered, sorted_groups, spread
from seqloom.plans.recovery import cut, table


def node_traits(nodes: DataFrame, traits: DataFrame, mode: str = "maxunique", mixed: str = "Mix", explain: str | None = None) -> DataFrame:
    """(node, trait): the traits (name, trait) of each node's (name, node) members as one.

    ``unique``: the one trait, or ``mixed`` (or ``explain`` and all of them) of several; ``maxunique``: the first in
    order of those that are known; ``mean``, ``max``, ``min``, and ``cnt`` for the sum.
    """
    rows = nodes.select("name", "node").join(traits.select("name", "trait"), "name", "left")
    if mode == "unique":
        found = F.array_sort(F.collect_set(F.coalesce(F.col("trait").cast("string"), F.lit("NA"))))
        many = F.lit(mixed) if explain is None else F.concat(F.lit(explain), F.array_join("all", ","))
        return rows.groupBy("node").agg(found.alias("all")).select("node", F.when(F.size("all") > 1, many).otherwise(F.get("all", F.lit(0))).alias("trait"))
    if mode == "maxunique":
        return rows.groupBy("node").agg(F.min(F.col("trait").cast("string")).alias("trait"))
    value = {"mean": F.avg, "max": F.max, "min": F.min, "cnt": F.sum}
    if mode not in value:
        raise ValueError(f"unknown mode: {mode}")
    return rows.groupBy("node").agg(value[mode]("trait").alias("trait"))


#: Cells that are compared at once: these and what is counted of them stay in a cache.
CELLS = 1 << 18


def _covers(a: np.ndarray, b: np.ndarray) -> float:
    """The larger share, of either side's 15-symbol windows, that agree in 12 places with a window of the other.

    Cells lie in one row after another, so that the next cell of a diagonal is always as far ahead; sums of 2, 4 and 8
    cells of a diagonal make those of 15.
    """
    n, m = len(a) - 14, len(b) - 14
    if min(n, m) < 1:
        return 0.0
    ours, theirs = 0, np.zeros(m, dtype=bool)
    step = max(15, CELLS // len(b) - 14)
    for at in range(0, n, step):
        part = a[at : at + step + 14]
        k = len(part)
        one = (b[:, None] == part[None, :]).ravel().view(np.uint8)
        k += 1
        two = one[:-k] + one[k:]
        four = two[: -2 * k] + two[2 * k :]
        eight = four[: -4 * k] + four[4 * k :]
        size = len(one) - 14 * k
        total = eight[:size] + four[8 * k : 8 * k + size]
        total += two[12 * k : 12 * k + size]
        total += one[14 * k :]
        k -= 1
        # The last row of cells ends with its last window.
        found = np.zeros(m * k, dtype=bool)
        np.greater_equal(total, 12, out=found[:size])
        found = found.reshape(m, k)[:, : k - 14]
        ours += int(found.any(axis=0).sum())
        theirs |= found.any(axis=1)
    return max(ours / n, int(theirs.sum()) / m)


def flank_score(s1: str, s2: str, flank: int = 200) -> float:
    """The best cover between ``s1`` and either end of ``s2``, on both strands and in both directions; ends of up to ``flank`` symbols."""
    return end_score(s1, s2[:flank], s2[max(0, len(s2) - flank) :])


def end_score(s1: str, head: str, tail: str) -> float:
    """``flank_score`` of ``s1`` and a sequence of which the ends are given."""
    n = min(len(s1), len(head))
    if n == 0:
        return 0.0
    own = codes.symbols(s1)
    ends = [codes.symbols(e) for e in dict.fromkeys((head[:n], tail[len(tail) - n :]))]
    return max(_covers(own, e) for end in ends for e in (end, codes.opposite(end)))


def _low_pairs(pairs: DataFrame, seqs: DataFrame, flank: int, cover: float) -> DataFrame:
    """(src, dst) of ``pairs`` whose flanks score under ``cover``; texts are compared once for each two different ones.

    The texts of all pairs are written once; one is known by 256 bits of hash until the pairs of texts are, then each first text is sent
    once to where its pairs are, and of the second ones only their ends.
    """
    needed = pairs.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    texts = table(seqs.where("seq IS NOT NULL").join(needed, "name", "left_semi").select("name", F.unhex(F.sha2("seq", 256)).alias("text"), "seq"), "flanks")
    first = texts.groupBy("text").agg(F.min("name").alias("name"))
    ends = lambda end, text: texts.select(F.col("name").alias(end), F.col("text").alias(text))
    both = cut(pairs.join(ends("src", "a"), "src").join(ends("dst", "b"), "dst").select("src", "dst", "a", "b"))
    of = lambda text: texts.join(first.join(both.select(F.col(text).alias("text")).distinct(), "text", "left_semi"), ["name", "text"])
    heads = of("b").select(F.col("text").alias("b"), F.left("seq", F.lit(flank)).alias("head"), F.right("seq", F.lit(flank)).alias("tail"))
    sent = both.select("a", "b").distinct().join(heads, "b").select("a", "b", "head", "tail")
    sent = of("a").select(F.col("text").alias("a"), F.lit(None).alias("b"), F.col("seq").alias("head"), F.lit(None).alias("tail")).unionByName(sent)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def low() -> Iterator[pa.RecordBatch]:
            for group in sorted_groups(batches):
                seq, rest = group.column("head")[0].as_py(), group.filter(pc.is_valid(group.column("b"))).select(["a", "b", "head", "tail"])
                found = [end_score(seq, h, t) < cover for h, t in zip(rest.column("head").to_pylist(), rest.column("tail").to_pylist(), strict=True)]
                yield from rest.select(["a", "b"]).filter(pa.array(found, pa.bool_())).to_batches()

        yield from gathered(low())

    dealt = spread(sent, "a").sortWithinPartitions("a", F.col("b").asc_nulls_first())
    low = cut(dealt.mapInArrow(kernel, "a binary, b binary"))
    return both.join(low, ["a", "b"], "left_semi").select("src", "dst")


def _tested(edges: DataFrame, seqs: DataFrame, side: str, share: float, cover: float, flank: int, single: bool) -> DataFrame:
    """``edges`` without those between nodes that do not hold together; ``side`` is the end that has several neighbours."""
    nodes = cut(gr.strong_components(edges))
    compact = cut(gr.condensed(edges, nodes))
    sizes = nodes.groupBy("node").agg(F.count("*").alias("size"))
    several = compact.groupBy(side).count().where("count > 1").select(side)
    c = compact.join(several, side, "left_semi")
    if side == "dst":  # only nodes that nothing leaves
        c = c.join(compact.select(F.col("src").alias("dst")).distinct(), "dst", "left_anti")
    c = c.join(sizes.select(F.col("node").alias("src"), F.col("size").alias("a")), "src").join(sizes.select(F.col("node").alias("dst"), F.col("size").alias("b")), "dst")
    fit = (F.col("n_src") / F.col("a") >= share) & (F.col("n_dst") / F.col("b") >= share)
    if single:
        fit = fit & (F.col("b") > 1)
    named = edges.join(nodes.select(F.col("name").alias("src"), F.col("node").alias("from")), "src").join(nodes.select(F.col("name").alias("dst"), F.col("node").alias("to")), "dst")
    one = named.groupBy("from", "to").agg(F.min(F.struct("src", "dst")).alias("e"))
    pairs = c.select(F.col("src").alias("from"), F.col("dst").alias("to"), fit.alias("fit"))
    held = cut(pairs.where("fit").join(one, ["from", "to"]).select("from", "to", "e.src", "e.dst"))  # flanks are compared for pairs that pass the first test alone
    low = held.join(_low_pairs(held.select("src", "dst"), seqs, flank, cover), ["src", "dst"], "left_semi")
    gone = pairs.where("NOT fit").select("from", "to").unionByName(low.select("from", "to"))
    return named.join(gone, ["from", "to"], "left_anti").select("src", "dst")


def without_forks(edges: DataFrame, seqs: DataFrame, share: float = 0.7, cover: float = 0.8, flank: int = 200) -> DataFrame:
    """``edges`` where a node that leads to several keeps those it holds together with.

    Both nodes must be joined by ``share`` of their members, and the ends of a joined pair (the first by name) must cover each other by ``cover``.
    """
    return _tested(edges, seqs, "src", share, cover, flank, False)


def without_umbrellas(edges: DataFrame, seqs: DataFrame, share: float = 0.7, cover: float = 0.8, flank: int = 200) -> DataFrame:
    """The same for final nodes that several lead to; those of one member lose all their edges."""
    return _tested(edges, seqs, "dst", share, cover, flank, True)


def family_edges(edges: DataFrame, components: DataFrame, component) -> DataFrame:
    """The edges inside one component of (node, component)."""
    own = components.where(F.col("component") == component).select("node")
    return edges.join(own.withColumnRenamed("node", "src"), "src", "left_semi").join(own.withColumnRenamed("node", "dst"), "dst", "left_semi").select("src", "dst")


def oriented(families: DataFrame, seqs: DataFrame, nested: DataFrame, rounds: int = 100) -> DataFrame:
    """(family, name, strand, seq): each family's sequences in one direction, longest first known.

    ``families`` is (family, name), ``nested`` (src, dst, strand, coverage).  The longest sequence takes the strand of its longest reading
    frame (+ without one); others follow round by round from a neighbour that is known, the best covered and then the first by name.
    Sequences that nothing links are left out; ``seq`` is turned where the strand is minus.
    """
    s = families.join(seqs.select("name", "seq"), "name")
    order = F.row_number().over(Window.partitionBy("family").orderBy(F.desc(F.length("seq")), "name"))
    heads = s.withColumn("r", order).where("r = 1").select("family", "name", "seq")
    frames = of.best(of.six_frames(heads.select("name", "seq"))).select("name", "strand")
    known = cut(heads.join(frames, "name", "left").select("family", "name", F.coalesce("strand", F.lit("+")).alias("strand")))
    both = nested.select("src", "dst", "strand", "coverage").unionByName(nested.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "strand", "coverage"))
    f = lambda c: families.select(F.col("name").alias(c), F.col("family").alias(f"f_{c}"))
    links = cut(both.join(f("src"), "src").join(f("dst"), "dst").where("f_src = f_dst and src <> dst").select(F.col("f_src").alias("family"), "src", "dst", F.col("strand").alias("side"), "coverage"))
    for _ in range(rounds):
        reach = known.withColumnRenamed("name", "src").join(links, ["family", "src"]).join(known.select("family", F.col("name").alias("dst")), ["family", "dst"], "left_anti")
        rank = F.row_number().over(Window.partitionBy("family", "dst").orderBy(F.desc("coverage"), "src", "side"))
        turned = F.when(F.col("side") == "+", F.col("strand")).when(F.col("strand") == "+", "-").otherwise("+")
        new = cut(reach.withColumn("r", rank).where("r = 1").select("family", F.col("dst").alias("name"), turned.alias("strand")))
        if new.isEmpty():
            break
        known = cut(known.unionByName(new))
    else:
        raise RuntimeError(f"directions did not settle in {rounds} rounds")
    return known.join(seqs.select("name", "seq"), "name").select("family", "name", "strand", F.when(F.col("strand") == "-", rev_compl(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def merge_candidates(hits: DataFrame, gap: int = 1000, most: int = 50_000) -> DataFrame:
    """(type, chr, idx, beg, end, len): neighbours of one type on a chromosome at most ``gap`` apart, as one range each.

    ``hits`` is (idx, type, chr, beg, end); a range over ``most`` raises.
    """
    by = Window.partitionBy("type", "chr").orderBy("idx")
    pairs = hits.withColumns({"nb": F.lead("beg").over(by), "ne": F.lead("end").over(by)}).where(F.col("nb") - F.col("end") <= gap)
    bad = F.when(F.col("ne") - F.col("beg") > most, F.raise_error(F.lit("a merged range is too long")).cast("long"))
    return pairs.select("type", "chr", "idx", "beg", F.coalesce(bad, F.col("ne")).alias("end")).withColumn("len", F.col("end") - F.col("beg") + 1)


def merged_again(candidates: DataFrame, copies: int = 3) -> DataFrame:
    """(id, chr, beg, end, len): neighbouring candidates (id, chr, beg, end, total) that both have ``copies`` or more, as one range each."""
    kept = candidates.where(F.col("total") >= copies)
    nxt = kept.select((F.col("id") - 1).alias("id"), F.col("beg").alias("b2"), F.col("end").alias("e2"))
    both = kept.join(nxt, "id").select("id", "chr", F.least("beg", "b2", "end", "e2").alias("beg"), F.greatest("beg", "b2", "end", "e2").alias("end"))
    return both.withColumn("len", F.col("end") - F.col("beg") + 1)


def outermost(candidates: DataFrame) -> DataFrame:
    """Candidates (chr, id, beg, end) that lie in no other one; of equal ranges the first id stays."""
    inner = contained(candidates.select("chr", "beg", "end", "id"), ["chr"], ["id"])
    return candidates.join(inner.select("chr", "id"), ["chr", "id"], "left_anti")
