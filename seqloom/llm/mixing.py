"""Mixing sources to target token counts by entropy balancing.

For each source the document rates r minimise the relative entropy to one copy each,
sum of r ln r - r, under 0 <= r <= cap and sum of r * size = target.  The dual is
convex in one multiplier a source and gives r = min(cap, exp(a * size / mean size)).  Newton
steps, kept inside a shrinking bracket, solve all sources at once; every step is one
aggregation over (source, size) classes.  Rates become copies by a hashed rounding whose offset
is searched per source, and a few documents then take up what is left.  What decides a document's
copies is its id, source and size and a few numbers a source, so texts never move.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import WORD, packed
from seqloom.plans.recovery import cut

CAP = 3
MANY = 100_000  # rows that are broadcast, at most


def targets(sizes: dict, cycle: tuple[int, ...] = (1, 2, 3), cap: float = CAP) -> dict:
    """Each source's target: its share of all sizes by weight, at most ``cap`` times its own size.

    Sources stand by code point, null last, and take the weights in turn; what a capped source
    cannot take is shared among the others by weight until none is above its cap.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    out, free, left = {}, list(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        out |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free = [s for s in free if s not in over]
    return out


def _hinted(table: DataFrame, values) -> DataFrame:
    """``table``, which holds a row for each of ``values``, to be broadcast unless they are many."""
    return F.broadcast(table) if len(values) <= MANY else table


def _per_source(rows: DataFrame, params: dict, names: list[str]) -> DataFrame:
    """``rows`` with each source's parameters, one row a source."""
    table = rows.sparkSession.createDataFrame([(s, *map(float, v)) for s, v in params.items()], "s string, " + ", ".join(f"{n} double" for n in names))
    return rows.join(_hinted(table, params), rows["source"].eqNullSafe(table["s"])).drop("s")


def _rate(tilt: Column, size: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(tilt * size, F.lit(60.0))))


def multipliers(classes: DataFrame, totals: dict, goal: dict, cap: float = CAP, steps: int = 60) -> dict:
    """a / mean size of each source, from ``classes`` (source, size, n): n documents of a size."""
    out, state = {}, {}
    for s, (tokens, docs) in totals.items():
        if tokens == 0 or goal[s] >= cap * tokens * (1 - 1e-9):
            out[s] = 1e9 if tokens else 0.0
        else:
            state[s] = [0.0, None, None, tokens / docs]
    for _ in range(steps):
        if not state:
            break
        at = _per_source(classes, {s: (v[0] / v[3], 1.0 / v[3]) for s, v in state.items()}, ["tilt", "unit"])
        r, x = _rate(F.col("tilt"), F.col("size"), cap), F.col("size") * F.col("unit")
        sums = at.groupBy("source").agg(F.sum(F.col("n") * x * r).alias("mass"), F.sum(F.when(r < cap, F.col("n") * x * x * r).otherwise(0.0)).alias("slope"))
        for row in sums.collect():
            s, v = row.source, state[row.source]
            gap = row.mass - goal[s] / v[3]
            if abs(gap) <= 1e-7 * goal[s] / v[3]:
                out[s] = round(v[0], 9) / v[3]
                continue
            v[1 if gap < 0 else 2] = v[0]
            lo, hi = v[1], v[2]
            new = v[0] - gap / row.slope if row.slope > 1e-12 else math.inf
            if lo is not None and hi is not None:
                v[0] = new if lo < new < hi else (lo + hi) / 2
            elif hi is None:
                v[0] = min(new, 2 * abs(lo) + 1)
            else:
                v[0] = max(new, -2 * abs(hi) - 1)
        state = {s: v for s, v in state.items() if s not in out}
    return out | {s: round(v[0], 9) / v[3] for s, v in state.items()}


def copies(rate: Column, draw: Column, offset: Column, cap: int = CAP) -> Column:
    return F.least(F.lit(cap), F.greatest(F.lit(0), F.floor(rate + draw + offset))).cast("long")


def _settle(found: list[tuple], lack: float, cap: int, most: int = 8) -> dict:
    """Changes of copies, by (doc_id, size), that leave little of ``lack``.

    ``found`` is (doc_id, size, weight, copies).  Each turn makes the one or two moves on
    different documents that help most, until none helps.
    """
    more = {r[:2]: 0 for r in found}
    order = sorted(found, key=lambda r: (r[2], str(r[0])))
    for _ in range(most):
        moves = [(sign * w, (d, z)) for d, z, w, c in order for sign in (1, -1) if 0 <= c + more[d, z] + sign <= cap]
        best, left = (), abs(lack)
        for i, a in enumerate(moves):
            if abs(lack - a[0]) < left:
                best, left = (a,), abs(lack - a[0])
            for b in moves[i + 1 :]:
                if a[1] != b[1] and abs(lack - a[0] - b[0]) < left:
                    best, left = (a, b), abs(lack - a[0] - b[0])
        for w, key in best:
            more[key] += 1 if w > 0 else -1
            lack -= w
        if not best or abs(lack) < 1:
            break
    return more


@dataclass(frozen=True)
class Plan:
    """What the mix needs to know of each source, and the few documents whose copies are changed after rounding."""

    params: dict  # source: (tilt, offset, size of the source, target)
    changed: list[tuple]  # (doc_id, source, size, more)
    cap: int


def _size(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _draw() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 40)) / float(1 << 40)


def _few(fixed: DataFrame, lacking: dict, repairs: int) -> dict:
    """By source, some ``repairs`` documents whose weight is nearest to what lacks, and as many others.

    Counts by source and power of two of the distance say which hashes are low enough to come to the driver.
    """
    near = _per_source(fixed, {s: (v,) for s, v in lacking.items()}, ["lack"])
    near = near.withColumn("far", F.floor(F.log2(F.abs(F.col("weight") - F.abs("lack")) + 1)).cast("int"))
    near = near.withColumn("lot", F.pmod(F.xxhash64("doc_id", "size", F.lit("few")), F.lit(1 << 30)) / float(1 << 30))
    below, seen, total = [], {}, {}
    counts = sorted(near.groupBy("source", "far").count().collect(), key=lambda r: (str(r.source), r.far))
    for r in counts:
        total[r.source] = total.get(r.source, 0) + r["count"]
    for r in counts:
        own = 4 * repairs / r["count"] if seen.get(r.source, 0) < repairs else 0.0
        below.append((r.source, r.far, max(own, 2 * repairs / total[r.source])))
        seen[r.source] = seen.get(r.source, 0) + r["count"]
    limits = near.sparkSession.createDataFrame(below, "s string, f int, below double") if below else None
    by: dict = {}
    if limits is not None:
        chosen = near.join(_hinted(limits, below), near["source"].eqNullSafe(limits["s"]) & (near["far"] == limits["f"])).where("lot < below")
        for r in chosen.select("doc_id", "source", "size", "weight", "copies", "far", "lot").collect():
            by.setdefault(r.source, []).append(r)
    out = {}
    for s, rows in by.items():
        close = sorted(rows, key=lambda r: (abs(r.weight - abs(lacking[s])), str(r.doc_id), r["size"]))[:repairs]
        others = sorted(rows, key=lambda r: (r.lot, str(r.doc_id), r["size"]))[:repairs]
        out[s] = [(r.doc_id, r["size"], r.weight, r.copies) for r in dict.fromkeys([*close, *others])]
    return out


def plan(rows: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), cap: int = CAP, fine: int = 32, rounds: int = 4, repairs: int = 48) -> Plan:
    """The mix of ``rows`` (doc_id, source, size)."""
    totals = {r.source: (r.tokens, r.docs) for r in rows.groupBy("source").agg(F.sum("size").alias("tokens"), F.count("*").alias("docs")).collect()}
    goal = targets({s: t for s, (t, _) in totals.items()}, cycle, cap)
    classes = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    tilt = multipliers(classes, totals, goal, cap)

    draw, rate = _draw(), _rate(F.col("tilt"), F.col("size"), cap)
    units = cut(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")))
    offset, low, width = dict.fromkeys(tilt, 0.0), dict.fromkeys(tilt, -1.0), 2.0
    got: dict = {}
    for _ in range(rounds):
        step = width / fine
        tried = _per_source(units, {s: (tilt[s], low[s]) for s in tilt}, ["tilt", "low"])
        tried = tried.withColumns({"rate": rate, "draw": draw})
        sums = tried.groupBy("source").agg(*[F.sum(F.col("n") * F.col("size") * copies(F.col("rate"), F.col("draw"), F.col("low") + k * step, cap)).alias(f"k{k}") for k in range(fine + 1)])
        for r in sums.collect():
            found = [r[f"k{k}"] for k in range(fine + 1)]
            best = min(range(fine + 1), key=lambda k: (abs(found[k] - goal[r.source]), k))
            if r.source not in got or abs(found[best] - goal[r.source]) < abs(got[r.source] - goal[r.source]):
                offset[r.source], got[r.source] = low[r.source] + best * step, found[best]
            below = max((k for k in range(fine + 1) if found[k] <= goal[r.source]), default=0)
            low[r.source] += min(below, fine - 1) * step
        width = step

    fixed = _per_source(units, {s: (tilt[s], offset[s]) for s in tilt}, ["tilt", "offset"])
    fixed = fixed.withColumns({"copies": copies(rate, draw, F.col("offset"), cap), "weight": F.col("n") * F.col("size")}).where("weight > 0")
    lacking = {s: float(goal[s] - got.get(s, 0)) for s in goal}
    # Twice ``repairs`` documents a source at most.
    changed = [(d, s, z, more) for s, found in _few(fixed, lacking, repairs).items() for (d, z), more in _settle(found, lacking[s], cap).items() if more]
    return Plan({s: (tilt[s], offset[s], totals[s][0], goal[s]) for s in tilt}, changed, cap)


def counted(rows: DataFrame, made: Plan) -> DataFrame:
    """``rows``, which hold doc_id, source and size, with source_size, target and copies; nothing is shuffled."""
    done = _per_source(rows, made.params, ["tilt", "offset", "source_size", "target"])
    done = done.withColumn("copies", copies(_rate(F.col("tilt"), F.col("size"), made.cap), _draw(), F.col("offset"), made.cap))
    if made.changed:
        fix = _hinted(rows.sparkSession.createDataFrame(made.changed, "doc_id long, source string, size long, more long"), made.changed).alias("b")
        same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size"))
        done = done.alias("a").join(fix, same, "left").select("a.*", "b.more").withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).drop("more")
    return done.withColumn("copies", F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).cast("long")).drop("tilt", "offset")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), _size(text_col).alias("size")]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row for each row of ``docs``.

    A null text has size 0 and a null source is a source of its own.  Rows of equal
    id, source and size, null ids too, get equal copies.  Texts without words are taken once.  The result
    depends on nothing but the rows; an empty table gives an empty result.  The number of sources bounds
    what the driver holds.  ``how`` goes to ``plan``.
    """
    rows = cut(docs.select(*_sized(docs, id_col, text_col, source_col)))
    done = counted(rows, plan(rows, **how))
    return done.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, each repeated as often as ``mix`` takes it, with all their columns under their own names.

    Each row's copies are computed where it lies.  Nulls, ties, repeated rows and empty tables are
    as in ``mix``.
    """
    made = plan(cut(docs.select(*_sized(docs, id_col, text_col, source_col))), **how)
    rows = counted(docs.select(packed(docs).alias("row"), *_sized(docs, id_col, text_col, source_col)), made).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")
