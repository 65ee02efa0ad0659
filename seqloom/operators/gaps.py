"""What lies between hits: skeletons, free segments, offsets, support of blocks and base-wise correspondence."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.functions.sequence import rev_compl
from seqloom.operators import hits as ht
from seqloom.operators import kernels as ke
from seqloom.operators.intervals import merged, overlap_join
from seqloom.plans.groups import dealt, solve


# --- skeleton -------------------------------------------------------------------------------------
def first_hits(hits: DataFrame, order: str) -> DataFrame:
    """The first row of each run of one query id along ``order`` within a target."""
    by = Window.partitionBy("s_id").orderBy(order)
    return hits.withColumn("__last", F.lag("q_id").over(by)).where("__last IS NULL OR __last <> q_id").drop("__last")


def in_order(blocks: list[tuple[int, int, int]], least: int) -> list[int]:
    """The blocks that stay of (block, place along the query, length), given in their order along the target.

    A block is loose while a neighbour along the target is no neighbour along the query; the last one along the target never is.
    The shortest loose block (ties: the first) falls as long as it is at most ``least`` long.  Neighbours are two
    linked lists, and loose blocks wait in a heap, so a fall costs a logarithm.
    """
    n = len(blocks)
    along = [list(range(-1, n - 1)), [*range(1, n), -1]]  # before and after each block, along the target
    across = [[-1] * n, [-1] * n]  # along the query
    order = sorted(range(n), key=lambda k: blocks[k][1])
    for k, m in zip(order, order[1:], strict=False):
        across[1][k], across[0][m] = m, k
    alive = [True] * n

    def loose(k: int) -> bool:
        if k < 0 or not alive[k] or along[1][k] < 0:
            return False
        near = (across[0][k], across[1][k])
        return any(x >= 0 and x not in near for x in (along[0][k], along[1][k]))

    wait = [(blocks[k][2], k) for k in range(n) if loose(k)]
    heapify(wait)
    while wait and wait[0][0] <= least:
        _, k = heappop(wait)
        if not loose(k):
            continue
        alive[k] = False
        for before, after in (along, across):
            x, y = before[k], after[k]
            if x >= 0:
                after[x] = y
            if y >= 0:
                before[y] = x
        # Whose neighbours are others now, and whose neighbours' neighbours are.
        touched = {along[0][k], along[1][k], across[0][k], across[1][k]} - {-1}
        for m in touched:
            if loose(m):
                heappush(wait, (blocks[m][2], m))
    return [blocks[k][0] for k in range(n) if alive[k]]


def skeletons(hits: DataFrame, least: int = 20_000) -> DataFrame:
    """(s_id, number, block): the hits of each target that keep the query's order, for hits (s_id, number, q_beg, s_beg, s_end, aln_len), one a fragment.

    Along the target (ties: the longest first) a hit falls if it ends within the one before it, and then if both its neighbours are
    no neighbours along the query.  What is left forms blocks of neighbours along both; loose blocks of up to ``least``
    positions fall (``in_order``).  Blocks are numbered anew, and a turn of direction begins one.  A target's
    hits are sorted in one task, and its blocks, one row each, are solved in one.
    """
    rows = hits.select("s_id", "number", "q_beg", F.least("s_beg", "s_end").alias("lo"), F.greatest("s_beg", "s_end").alias("hi"), F.col("aln_len").alias("len"), (F.col("s_beg") > F.col("s_end")).alias("back"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("s_id").orderBy("q_beg", "number")))
    along, across = Window.partitionBy("s_id").orderBy("lo", F.desc("len"), "place"), Window.partitionBy("s_id").orderBy("place")
    renumbered = lambda df: df.withColumn("place", F.row_number().over(across))
    step = lambda fn: F.abs(fn("place").over(along) - F.col("place"))
    rows = renumbered(rows.withColumn("last", F.lag("hi").over(along)).where("last IS NULL OR hi > last"))
    rows = renumbered(rows.withColumns({"was": step(F.lag), "next": step(F.lead)}).where(~F.coalesce((F.col("was") > 1) & (F.col("next") > 1), F.lit(False))))
    count = along.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("new", F.coalesce(step(F.lag) != 1, F.lit(True)).cast("long")).withColumn("own", F.sum("new").over(count))
    blocks = rows.groupBy("s_id", "own").agg(F.max(F.when(F.col("new") == 1, F.col("place"))).alias("place"), (F.max("hi") - F.min("lo")).alias("length"))
    kept = solve(blocks.select("s_id", "own", "place", "length"), ["s_id"], lambda key, own: [(*key, k) for k in in_order(sorted(own), least)], f"s_id {hits.schema['s_id'].dataType.simpleString()}, own long")
    rows = renumbered(rows.drop("new").join(kept, ["s_id", "own"]))
    same = (step(F.lag) == 1) & (F.lag("back").over(along) == F.col("back"))
    rows = rows.withColumn("new", F.when(same, 0).otherwise(1))
    return rows.select("s_id", F.col("number").cast("long").alias("number"), F.sum("new").over(count).alias("block"))


# --- free segments ----------------------------------------------------------------------------------
def free_segments(used: DataFrame, keys: list[str], length: Column, least: int = 50, most: int = 1_000_000) -> DataFrame:
    """(keys, beg, end): what intervals leave free of axes of ``length`` positions, ends included, of ``least`` to ``most`` positions.

    ``length`` is an expression over the keys and ``used``'s columns, the same for all rows of a key.
    """
    lengths = used.groupBy(*keys).agg(F.max(length).alias("__len"))
    m = merged(used.select(*keys, "beg", "end"), keys, 1).select(*keys, "beg", "end").join(lengths, keys)
    by = Window.partitionBy(*keys).orderBy("beg")
    after = m.select(*keys, (F.col("end") + 1).alias("beg"), F.coalesce(F.lead("beg").over(by) - 1, F.col("__len")).alias("end"))
    before = m.groupBy(*keys).agg(F.lit(1).cast("long").alias("beg"), (F.min("beg") - 1).alias("end"))
    return after.unionByName(before).where((F.col("end") - F.col("beg") + 1).between(least, most))


def chunks(segments: DataFrame, size: int = 500) -> DataFrame:
    """Segments in pieces of ``size`` from their begin on; the last one may be shorter."""
    rest = [c for c in segments.columns if c not in ("beg", "end")]
    at = segments.withColumn("__b", F.explode(F.sequence(F.col("beg"), F.col("end"), F.lit(size).cast("long"))))
    return at.select(*rest, F.col("__b").alias("beg"), F.least(F.col("__b") + (size - 1), F.col("end")).alias("end"))


def known_pieces(pieces: DataFrame, seqs: DataFrame, key: str, unknown: float = 0.5) -> DataFrame:
    """``pieces`` (key, beg, end) with their seq from (key, seq); those of more than ``unknown`` N go."""
    cut = pieces.join(seqs.select(key, "seq"), key).withColumn("seq", F.substr("seq", F.col("beg").cast("int"), (F.col("end") - F.col("beg") + 1).cast("int")))
    n = F.length("seq") - F.length(F.translate(F.upper("seq"), "N", ""))
    return cut.where(n <= unknown * F.length("seq"))


def segment_shifts(segments: DataFrame, keys: list[str]) -> DataFrame:
    """``segments`` (keys, beg, end) with shift: the lengths of the segments before each, so that they abut."""
    own = segments.distinct().withColumn("len", F.col("end") - F.col("beg") + 1)
    before = F.sum("len").over(Window.partitionBy(*keys).orderBy("beg", "end").rowsBetween(Window.unboundedPreceding, -1))
    return own.withColumn("shift", F.coalesce(before, F.lit(0)))


def local_positions(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Hits in coordinates that begin at 1 on both axes of each key, targets on a forward axis: (.., len_s)."""
    lo, hi = F.least("s_beg", "s_end"), F.greatest("s_beg", "s_end")
    own = hits.withColumns({"s_beg": lo, "s_end": hi})
    by = Window.partitionBy(*keys)
    q, s = F.min("q_beg").over(by), F.min("s_beg").over(by)
    moved = own.withColumns({"q_beg": F.col("q_beg") - q + 1, "q_end": F.col("q_end") - q + 1, "s_beg": F.col("s_beg") - s + 1, "s_end": F.col("s_end") - s + 1})
    return moved.withColumn("len_s", F.col("s_end") - F.col("s_beg") + 1)


# --- joins of hits and blocks -----------------------------------------------------------------------
def supported(blocks: DataFrame, hits: DataFrame, keys: list[str], share: float = 0.9, bins: int = 1024) -> DataFrame:
    """The ids of blocks (keys, id, beg, end, s_beg) of which a hit (keys, beg, end, s_beg, s_end, len) covers ``share``, in place.

    Lengths are end less begin.  The hit's target, moved by how far the block's two begins are apart, must share ``share`` of the
    hit's length with its query range.
    """
    pairs = overlap_join(blocks, hits, keys, bins)
    shared = F.least("end_a", "end_b") - F.greatest("beg_a", "beg_b")
    move = F.col("beg_a") - F.col("s_beg_a")
    along = F.least(F.col("end_b"), F.col("s_end_b") + move) - F.greatest(F.col("beg_b"), F.col("s_beg_b") + move)
    fit = (shared > 0) & (shared >= share * (F.col("end_a") - F.col("beg_a"))) & (along > share * F.col("len_b"))
    return pairs.where(fit).select(*keys, F.col("id_a").alias("id")).distinct()


def flanks_shared(hits: DataFrame) -> DataFrame:
    """Hits between segments (q_left, q_right) and (s_left, s_right) that have a flanking block in common."""
    same = (F.col("q_left") == F.col("s_left")) | (F.col("q_left") == F.col("s_right")) | (F.col("q_right") == F.col("s_left")) | (F.col("q_right") == F.col("s_right"))
    return hits.where(same)


def merged_gaps(hits: DataFrame, skeleton_hits: DataFrame, shifts: DataFrame) -> DataFrame:
    """(q_id, s_id, strand, q_beg, q_end, s_beg, s_end): hits within gaps, moved to their chromosomes and joined with the skeleton.

    ``hits`` (gap, q_id, s_id, q_beg, .., pident) count from the begins of their gap, ``shifts`` (gap, q_shift, s_shift) say where
    that is.  Hits are glued, rid of overlaps and chained; then skeleton and gaps are glued once more.
    """
    moved = hits.join(shifts, "gap").withColumns({"q_beg": F.col("q_beg") + F.col("q_shift"), "q_end": F.col("q_end") + F.col("q_shift"), "s_beg": F.col("s_beg") + F.col("s_shift"), "s_end": F.col("s_end") + F.col("s_shift")})
    one = ht.glued(moved.drop("gap", "q_shift", "s_shift"))
    fit = ke.shortest_chains(ke.clean_overlaps(one).drop("strand"))
    cols = ["q_id", "s_id", "q_beg", "q_end", "s_beg", "s_end"]
    both = dealt(fit.select(*cols).unionByName(skeleton_hits.select(*cols)), "q_id", "s_id").distinct().withColumn("pident", F.lit(0.0))
    return ht.glued(both).drop("n")


# --- base-wise correspondence ------------------------------------------------------------------------
def _places(text: Column) -> Column:
    """The ordinal of each symbol of an aligned string, 0 at gaps."""
    return codes.of_text("array<int>", pa.list_(pa.int32()), lambda t: codes.running(t, 0))(text)


def base_correspondence(hits: DataFrame) -> DataFrame:
    """(q_id, s_id, base, own): for each target position under a hit the query position, negative on the minus strand.

    ``hits`` is (number, q_id, s_id, q_beg, s_beg, s_end, q_aln, s_aln); later numbers overwrite, also with a gap,
    and positions that end up against a gap have no row.
    """
    back = F.col("s_beg") > F.col("s_end")
    cells = hits.select("number", "q_id", "s_id", "q_beg", "s_beg", back.alias("back"), F.explode(F.arrays_zip(_places(F.col("q_aln")).alias("q"), _places(F.col("s_aln")).alias("s"))).alias("c")).where("c.s > 0")
    base = F.when(F.col("back"), F.col("s_beg") - F.col("c.s") + 1).otherwise(F.col("s_beg") + F.col("c.s") - 1)
    own = F.when(F.col("c.q") == 0, 0).otherwise(F.when(F.col("back"), -1).otherwise(1) * (F.col("q_beg") + F.col("c.q") - 1))
    last = cells.select("q_id", "s_id", base.alias("base"), "number", own.cast("long").alias("own")).groupBy("q_id", "s_id", "base").agg(F.max_by("own", "number").alias("own"))
    return last.where("own <> 0")


def wrong_lengths(hits: DataFrame) -> DataFrame:
    """(number, side, symbols, span) of hits whose ungapped strings do not fit their coordinates."""
    size = lambda c: F.length(F.replace(c, F.lit("-"), F.lit(""))).cast("long")
    side = lambda name, text, b, e: hits.select("number", F.lit(name).alias("side"), size(text).alias("symbols"), (F.abs(F.col(e) - F.col(b)) + 1).cast("long").alias("span"))
    return side("query", "q_aln", "q_beg", "q_end").unionByName(side("base", "s_aln", "s_beg", "s_end")).where("symbols <> span")


def wrong_ends(hits: DataFrame, queries: DataFrame, bases: DataFrame, k: int = 10) -> DataFrame:
    """(number, side, found, wanted): hits whose last ``k`` aligned symbols differ from the genomes (id, seq); minus strands read the complement."""
    tail = lambda c: F.replace(F.upper(F.right(F.col(c), F.lit(k))), F.lit("-"), F.lit(""))
    q = hits.join(queries.select(F.col("id").alias("q_id"), "seq"), "q_id")
    n = F.length("found")
    q = q.select("number", F.lit("query").alias("side"), tail("q_aln").alias("found"), "seq", F.col("q_end").alias("at"))
    q = q.withColumn("wanted", F.upper(F.substr("seq", (F.col("at") - n + 1).cast("int"), n)))
    b = hits.join(bases.select(F.col("id").alias("s_id"), "seq"), "s_id").withColumn("back", F.col("s_beg") > F.col("s_end"))
    b = b.select("number", F.lit("base").alias("side"), tail("s_aln").alias("found"), "seq", "back", F.col("s_end").alias("at"))
    b = b.withColumn("wanted", F.upper(F.when(F.col("back"), rev_compl(F.substr("seq", F.col("at").cast("int"), n))).otherwise(F.substr("seq", (F.col("at") - n + 1).cast("int"), n))))
    cols = ["number", "side", "found", "wanted"]
    return q.select(*cols).unionByName(b.select(*cols)).where("found <> wanted")


def variants_of_hits(hits: DataFrame) -> DataFrame:
    """(s_id, type, s_beg, s_end, q_beg, q_end): substitutions and gaps inside aligned hits, and what lies between neighbours.

    Runs of mismatches are ``SNP``, runs of gaps in the base ``INS`` and in the query ``DEL``; between two hits of a target a
    stretch that is free on both axes is ``HDR``, on one of them ``DEL`` or ``INS``.
    """
    import pandas as pd

    def inner(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                q, s = codes.symbols(row.q_aln.upper()), codes.symbols(row.s_aln.upper())
                kind = np.where(s == codes.GAP, 1, np.where(q == codes.GAP, 2, np.where(q != s, 3, 0)))
                qn, sn = np.cumsum(q != codes.GAP), np.cumsum(s != codes.GAP)
                step = -1 if row.s_beg > row.s_end else 1
                at = np.flatnonzero(np.diff(kind, prepend=-1))
                for b, e in zip(at.tolist(), [*at[1:].tolist(), len(kind)], strict=True):
                    if kind[b]:
                        qb, sb = int(qn[b] - (q[b] != codes.GAP)), int(sn[b] - (s[b] != codes.GAP))
                        ends = sorted((row.s_beg + step * sb, row.s_beg + step * (max(int(sn[e - 1]), sb + 1) - 1)))
                        out.append((row.s_id, ("", "INS", "DEL", "SNP")[kind[b]], *ends, row.q_beg + qb, row.q_beg + max(int(qn[e - 1]), qb + 1) - 1))
            yield pd.DataFrame(out, columns=["s_id", "type", "s_beg", "s_end", "q_beg", "q_end"])

    inside = hits.select("s_id", "q_beg", "s_beg", "s_end", "q_aln", "s_aln").mapInPandas(inner, "s_id long, type string, s_beg long, s_end long, q_beg long, q_end long")
    by = Window.partitionBy("s_id", "q_id").orderBy("q_beg", "q_end")
    lo, hi = F.least("s_beg", "s_end"), F.greatest("s_beg", "s_end")
    between = hits.select("s_id", (F.lag("q_end").over(by) + 1).alias("qb"), (F.col("q_beg") - 1).alias("qe"), (F.lag(hi).over(by) + 1).alias("sb"), (lo - 1).alias("se")).where("qb IS NOT NULL")
    nq, ns = F.col("qe") - F.col("qb") + 1, F.col("se") - F.col("sb") + 1
    kind = F.when((nq > 0) & (ns > 0), "HDR").when(ns > 0, "DEL").when(nq > 0, "INS")
    return inside.unionByName(between.select("s_id", kind.alias("type"), F.col("sb").alias("s_beg"), F.col("se").alias("s_end"), F.col("qb").alias("q_beg"), F.col("qe").alias("q_end")).where("type IS NOT NULL"))
