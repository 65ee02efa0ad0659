"""Order-dependent operators: each group is solved in one task by a plain kernel.

The kernels are functions of plain Python values, so that they can be tested without Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.plans.groups import by_group, dealt, solve, spread

Hit = tuple[int, int, int, int]  # q_beg, q_end, s_beg, s_end on forward axes


# --- overlaps -------------------------------------------------------------------------------------
def drop_big_overlaps(hits: list[Hit], axis: int, most: float = 0.5) -> list[Hit]:
    """Of neighbours along ``axis`` (0 query, 2 subject), the shorter goes if their overlap is over ``most`` of it; repeated until none does."""
    hits = sorted(hits, key=lambda h: (h[axis], h[axis + 1], h))
    while True:
        gone = set()
        for i in range(len(hits) - 1):
            a, b = hits[i], hits[i + 1]
            shared = min(a[axis + 1], b[axis + 1]) - b[axis] + 1
            la, lb = a[axis + 1] - a[axis] + 1, b[axis + 1] - b[axis] + 1
            if shared > most * min(la, lb):
                gone.add(i if la < lb else i + 1)
        if not gone:
            return hits
        hits = [h for i, h in enumerate(hits) if i not in gone]


def trim_overlaps(hits: list[Hit], axis: int) -> list[Hit]:
    """What overlap is left is cut off the shorter neighbour, on both axes alike."""
    out = sorted(hits, key=lambda h: (h[axis], h[axis + 1], h))
    for i in range(len(out) - 1):
        a, b = out[i], out[i + 1]
        shared = a[axis + 1] - b[axis] + 1
        if shared > 0:
            if a[axis + 1] - a[axis] < b[axis + 1] - b[axis]:
                out[i] = (a[0], a[1] - shared, a[2], a[3] - shared)
            else:
                out[i + 1] = (b[0] + shared, b[1], b[2] + shared, b[3])
    return [h for h in out if h[0] <= h[1] and h[2] <= h[3]]


def cleaned(hits: list[Hit], most: float = 0.5) -> list[Hit]:
    """Hits without overlaps on either axis: dropping and trimming on the subject, then the query, until nothing changes."""
    while True:
        new = hits
        for axis in (2, 2, 0, 0):
            new = trim_overlaps(drop_big_overlaps(new, axis, most), axis)
        if sorted(new) == sorted(hits):
            return sorted(new)
        hits = new


# --- chains ---------------------------------------------------------------------------------------
def greedy(hits: list[Hit], most: float = 0.2) -> list[Hit]:
    """From left to right: the next hit that moves the query on by over 80 % of its length and whose subject cells are used by under ``most``."""
    out: list[Hit] = []
    reach, used = None, np.zeros(0, dtype=bool)
    top = max((h[3] for h in hits), default=0)
    used = np.zeros(top + 2, dtype=bool)
    for h in sorted(hits, key=lambda h: (h[0], -h[1], h[2], h[3])):
        n = h[1] - h[0] + 1
        fresh = n if reach is None else h[1] - max(reach, h[0] - 1)
        if fresh > (1 - most) * n and used[h[2] : h[3] + 1].mean() < most:
            out.append(h)
            used[h[2] : h[3] + 1] = True
            reach = h[1] if reach is None else max(reach, h[1])
    return out


def middle(h: Hit) -> tuple:
    """The order in which hits may follow each other: by their centres (twice them) on both axes."""
    return h[0] + h[1], h[2] + h[3], h


def gap_cost(a: Hit, b: Hit, share: float = 0.5) -> float:
    """The sum of both gaps from ``a`` to ``b``, 1 at least; a gap is the distance of the centres less both half lengths.

    Infinite if a centre goes back, or if an overlap (a gap below 0) is over ``share`` of either's length.
    """
    if a == b or a[0] + a[1] > b[0] + b[1] or a[2] + a[3] > b[2] + b[3]:
        return float("inf")
    cost = 0.0
    for k in (0, 2):
        la, lb = a[k + 1] - a[k], b[k + 1] - b[k]
        gap = (abs(b[k] + b[k + 1] - a[k] - a[k + 1]) - la - lb) / 2
        if gap < 0 and -gap > share * min(la, lb):
            return float("inf")
        cost += gap
    return cost if cost > 0 else 1


def shortest(hits: list[Hit]) -> list[Hit]:
    """The chain of least total gap from before the first to after the last hit: hits in order of their centres form an acyclic graph."""
    if not hits:
        return []
    order = sorted(set(hits), key=middle)
    lo, hi = (min(h[0] for h in order), min(h[2] for h in order)), (max(h[1] for h in order), max(h[3] for h in order))
    cost = [max(h[0] - lo[0] + h[2] - lo[1], 1) for h in order]
    last = [-1] * len(order)
    for j, b in enumerate(order):
        for i in range(j):
            c = cost[i] + gap_cost(order[i], b)
            if c < cost[j]:
                cost[j], last[j] = c, i
    end = min(range(len(order)), key=lambda j: (cost[j] + max(hi[0] - order[j][1] + hi[1] - order[j][3], 1), j))
    out = []
    while end != -1:
        out.append(order[end])
        end = last[end]
    return out[::-1]


def _per_pair(hits: DataFrame, find) -> DataFrame:
    """``find`` over each query, target and strand; minus-strand subjects are mirrored to a forward axis."""
    keys = ["q_id", "s_id", "strand"]
    h = hits.withColumn("strand", F.when(F.col("s_beg") > F.col("s_end"), "-").otherwise("+")).select(*keys, "q_beg", "q_end", "s_beg", "s_end")
    h = dealt(h, *keys).distinct()

    def kernel(key: tuple, rows: list[tuple]) -> list[tuple]:
        top = max(max(r[2], r[3]) for r in rows) + 1
        flip = (lambda x: x) if key[2] == "+" else (lambda x: top - x)
        return [(*key, a, b, flip(c), flip(d)) for a, b, c, d in find([(a, b, flip(c), flip(d)) for a, b, c, d in rows])]

    return solve(h, keys, kernel, "q_id long, s_id long, strand string, q_beg long, q_end long, s_beg long, s_end long")


def clean_overlaps(hits: DataFrame) -> DataFrame:
    """(q_id, s_id, strand, q_beg, q_end, s_beg, s_end) without overlaps on either axis, by ``cleaned``.

    Repeated hits count once; null names are names of their own; no hits give no rows.  A query, target and strand is
    solved in one task.
    """
    return _per_pair(hits, cleaned)


def greedy_chains(hits: DataFrame) -> DataFrame:
    """The hits of each query, target and strand that ``greedy`` takes; columns, repeats, nulls and tasks are as in ``clean_overlaps``."""
    return _per_pair(hits, greedy)


def shortest_chains(hits: DataFrame) -> DataFrame:
    """The hits of each query, target and strand on the chain of ``shortest``; columns, repeats, nulls and tasks are as in ``clean_overlaps``."""
    return _per_pair(hits, shortest)


# --- long breaks ----------------------------------------------------------------------------------
def _groups(members: list[tuple[int, int]]) -> list[list[int]]:
    """[begin, end] of what intervals that share a position cover together."""
    out: list[list[int]] = []
    for b, e in sorted(members):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return out


def excluded(members: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Of intervals that merge into a group longer than ``most``: those to leave out so that groups stay below it.

    The longest fall one by one, one at least, until all groups of the rest are shorter than ``most``.  Then
    those come back, longest first, that meet no group, or meet one that stays shorter than ``most`` with
    them; so an interval that is too long by itself stays if it stands alone.
    """
    order = sorted(members, key=lambda m: (m[0] - m[1], m))
    n = next((k for k in range(1, len(order)) if all(e - b + 1 < most for b, e in _groups(order[k:]))), len(order))
    groups, out = _groups(order[n:]), []
    for b, e in order[:n]:
        met = [g for g in groups if g[0] <= e and g[1] >= b]
        if not met:
            groups.append([b, e])
        elif len(met) == 1 and max(met[0][1], e) - min(met[0][0], b) + 1 < most:
            met[0][:] = [min(met[0][0], b), max(met[0][1], e)]
        else:
            out.append((b, e))
    return sorted(out)


def solve_long(intervals: DataFrame, most: int) -> DataFrame:
    """(key, beg, end) of distinct intervals that are left out so that merged groups have fewer than ``most`` positions."""
    by = Window.partitionBy("key").orderBy("beg", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    g = intervals.select("key", "beg", "end").distinct().withColumn("new", F.when(F.col("beg") <= reach, 0).otherwise(1))
    g = g.withColumn("g", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    span = Window.partitionBy("key", "g")
    long = g.withColumn("len", F.max("end").over(span) - F.min("beg").over(span) + 1).where(F.col("len") > most)

    def kernel(key: tuple, rows: list[tuple]) -> list[tuple]:
        return [(key[0], b, e) for b, e in excluded(rows, most)]

    return solve(long.select("key", "g", "beg", "end"), ["key", "g"], kernel, "key long, beg long, end long")


# --- alignment ------------------------------------------------------------------------------------
#: Cells of a table whose steps are held at once; a larger table keeps some of its rows and is computed again in parts from these.
CELLS = 1 << 24


def align(a: str, b: str, match: int = 1, mismatch: int = -1, opening: int = 5, extension: int = 2) -> tuple[str, str, int]:
    """A global alignment with affine gaps (a gap of n costs opening + n * extension), and its score.

    One byte a cell tells the steps back.  Beyond ``CELLS`` cells only every so many rows are kept and the steps between two of them are computed
    when the way back gets there, so memory grows with the root of one length times the other, and the alignment is the same.
    """
    n, m = len(a), len(b)
    low = -(1 << 30)
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    opened, ramp = opening + extension, extension * np.arange(m + 1)

    def rows(i: int, last: int, row: tuple, steps: np.ndarray | None) -> tuple:
        """The row ``last`` of the three tables (pair, gap in b, gap in a), from row ``i``; ``steps`` takes what each cell came from: two bits a table, the first of equals."""
        best, up, left = row
        for k in range(i + 1, last + 1):
            ends = np.maximum(best, up)
            most = np.maximum(ends, left)
            over = np.maximum(best, left) - opened
            on = up - extension
            if steps is not None:
                # From: a pair where it is best, else a gap in b, else one in a.
                came = np.where(best == most, 0, np.where(up == most, 1, 2)).astype(np.uint8)
                step = steps[k - i - 1]
                step[0] = 0
                step[1:] = came[:-1]
                step |= np.where(on >= over, 1, np.where(best >= left, 0, 2)).astype(np.uint8) << 2
            pair = np.full(m + 1, low, dtype=np.int64)
            pair[1:] = most[:-1] + np.where(y == x[k - 1], match, mismatch)
            up = np.maximum(over, on)
            up[0] = -opening - extension * k
            ends = np.maximum(pair, up)
            ends[0] = low
            left = np.full(m + 1, low, dtype=np.int64)
            left[1:] = np.maximum.accumulate(ends + ramp)[:-1] - ramp[1:] - opening
            if steps is not None:
                on = np.empty(m, dtype=bool)
                on[:1] = False
                on[1:] = left[1:-1] - extension == left[2:]
                step[1:] |= np.where(on, 2, np.where(pair[:-1] >= up[:-1], 0, 1)).astype(np.uint8) << 4
            best = pair
        return best, up, left

    first = np.full(m + 1, low, dtype=np.int64)
    first[0] = 0
    side = -opening - ramp
    side[0] = low
    size = max(n, 1) if (n + 1) * (m + 1) <= CELLS else max(1, int((24 * n) ** 0.5))
    kept = [(first, np.full(m + 1, low, dtype=np.int64), side)]
    for i in range(0, max(n, 1), size):
        if i + size < n:
            kept.append(rows(i, i + size, kept[-1], None))
    begin = (len(kept) - 1) * size
    steps = np.zeros((min(size, n), m + 1), dtype=np.uint8)
    end = rows(begin, n, kept.pop(), steps)
    i, j = n, m
    k = int(np.argmax([t[m] for t in end]))
    score = int(end[k][m])
    out: list[tuple[str, str]] = []
    while i or j:
        if not i:  # the first row is one gap
            out.extend(("-", c) for c in b[:j][::-1])
            break
        if i <= begin:
            begin -= size
            rows(begin, begin + size, kept.pop(), steps)
        step = int(steps[i - begin - 1, j])
        if k == 0:
            out.append((a[i - 1], b[j - 1]))
            i, j, k = i - 1, j - 1, step & 3
        elif k == 1:
            out.append((a[i - 1], "-"))
            i, k = i - 1, step >> 2 & 3
        else:
            out.append(("-", b[j - 1]))
            j, k = j - 1, step >> 4 & 3
    out.reverse()
    return "".join(p for p, _ in out), "".join(q for _, q in out), score


def remembered(solve: Callable) -> Callable:
    """``solve`` of texts; a worker keeps its last 2048 results of texts that hold at most 2048 symbols together, so equal ones are solved once."""
    kept = lru_cache(2048)(solve)

    @wraps(solve)
    def known(*texts: str, **more):
        return (kept if sum(map(len, texts)) <= 2048 else solve)(*texts, **more)

    return known


@remembered
def align_once(a: str, b: str) -> tuple[str, str, int]:
    return align(a, b)


def pairwise(pairs: DataFrame) -> DataFrame:
    """(id, a1, a2, score): global alignments of pairs (id, s1, s2), in Arrow batches; a task aligns equal short pairs once."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [align_once(s or "", t or "") for s, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            if found:
                one, two, score = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(one), pa.array(two), pa.array(score, pa.int64())], ["id", "a1", "a2", "score"])

    own = pairs.select(F.col("id").cast("long").alias("id"), "s1", "s2")
    return spread(own, "id").mapInArrow(kernel, "id long, a1 string, a2 string, score long")


def word_distances(seqs: list[str], size: int = 7) -> np.ndarray:
    """Distances of all pairs: differences of their counts of words over the longer length."""
    found = [codes.word_codes(codes.symbols(s), size) for s in seqs]
    row = np.repeat(np.arange(len(seqs)), [len(w) for w in found])
    shared = codes.shared_words(np.concatenate([np.zeros(0, np.uint64), *found]), row, len(seqs))
    words, length = np.array([len(w) for w in found]), np.array([len(s) for s in seqs])
    longer = np.maximum(np.maximum(length[:, None], length[None, :]), 1)
    return (words[:, None] + words[None, :] - 2 * shared) / longer


def star(seqs: list[str]) -> list[str]:
    """A multiple alignment around the sequence whose words are nearest to those of all (ties: the longest, then the last): each distinct sequence is aligned with it once."""
    unique = sorted(set(s for s in seqs if s), key=lambda s: (-len(s), s))
    if not unique:
        return list(seqs)
    total = dict(zip(unique, word_distances(unique, 4).sum(axis=1).round(9), strict=True))
    center = max(unique, key=lambda s: (-total[s], len(s), s))
    # How many symbols stand before each centre symbol, at most over all pairs.
    placed = {}
    before = [0] * (len(center) + 1)
    for s in unique:
        c, o, _ = align(center, s) if s != center else (center, center, 0)
        slots: list[str] = [""] * (len(center) + 1)
        cells, at = ["-"] * len(center), 0
        for x, y in zip(c, o, strict=True):
            if x == "-":
                slots[at] += y
            else:
                cells[at] = y
                at += 1
        placed[s] = (slots, cells)
        before = [max(n, len(x)) for n, x in zip(before, slots, strict=True)]
    out = {}
    for s, (slots, cells) in placed.items():
        parts = [slots[i].ljust(before[i], "-") + (cells[i] if i < len(cells) else "") for i in range(len(before))]
        out[s] = "".join(parts)
    width = len(next(iter(out.values())))
    return [out.get(s, "-" * width) for s in seqs]


@remembered
def star_once(*seqs: str) -> list[str]:
    return star(list(seqs))


def star_alignments(rows: DataFrame) -> DataFrame:
    """(id, row, aligned): multiple alignments of the sequences (id, seq) of each locus."""

    def kernel(group: pa.Table) -> list:
        seqs = sorted(s or "" for s in group.column("seq").to_pylist())
        return [group.column("id"), pa.array(range(len(seqs)), pa.int64()), pa.array(star_once(*seqs), pa.string())]

    return by_group(rows.select(F.col("id").cast("long").alias("id"), "seq"), "id", [], kernel, "id long, row long, aligned string")


# --- masks and chromosomes --------------------------------------------------------------------------
def unaligned(rows: list[str], most: float = 0.2) -> list[str]:
    """Rows whose gap-free blocks fall while over ``most`` of their columns hold other than one nucleotide.

    Blocks are tried once each, in the order of that share at the start (ties by row and place); columns are
    counted again after each block that falls.  Masked symbols become gaps.
    """
    if not rows or not rows[0]:
        return list(rows)
    n, width = len(rows), len(rows[0])
    if any(len(r) != width for r in rows):
        raise ValueError("rows of an alignment must have one length")
    points = np.frombuffer("".join(rows).encode("utf-32-le"), dtype=np.uint32).reshape(n, width)
    code = np.full((n, width), 4, dtype=np.uint8)
    counts = np.zeros((width, 5), dtype=np.int64)
    for k, x in enumerate("ACGT"):
        here = points == ord(x)
        code[here] = k
        counts[:, k] = here.sum(axis=0)
    kinds = (counts[:, :4] > 0).sum(axis=1)
    counts[:, 4] = n + 1  # other symbols are not counted, so theirs never runs out
    mixed = bytearray((kinds != 1).astype(np.uint8))
    # Blocks of one row after another, from where symbols begin to where they end.
    inner = np.zeros((n, width + 2), dtype=np.int8)
    inner[:, 1:-1] = points != ord("-")
    row, at = np.nonzero(np.diff(inner, axis=1))
    row, begin, end = row[::2], at[::2], at[1::2]
    total = np.concatenate(([0], np.cumsum(np.frombuffer(mixed, dtype=np.uint8), dtype=np.int64)))
    share = (total[end] - total[begin]) / (end - begin)
    order = np.lexsort((begin, row, -share))
    order = order[share[order] > most]
    cells, gone, ones, flags = code.tobytes(), bytearray(n * width), b"\1" * width, np.frombuffer(mixed, dtype=np.uint8)
    left, kind = memoryview(counts.reshape(-1)), memoryview(kinds)
    for r, b, e in zip(row[order].tolist(), begin[order].tolist(), end[order].tolist(), strict=True):
        if mixed.count(1, b, e) / (e - b) <= most:
            continue
        first = r * width
        gone[first + b : first + e] = ones[: e - b]
        if e - b > 64:
            own = np.arange(b, e) * 5 + code[r, b:e]
            counts.reshape(-1)[own] -= 1
            over = own[counts.reshape(-1)[own] == 0] // 5
            kinds[over] -= 1
            flags[over] = kinds[over] != 1
            continue
        for c, x in enumerate(cells[first + b : first + e], b):
            k = 5 * c + x
            now = left[k] - 1
            left[k] = now
            if not now:
                kind[c] = more = kind[c] - 1
                mixed[c] = more != 1
    out = np.where(np.frombuffer(gone, dtype=bool).reshape(n, width), np.uint32(ord("-")), points).astype("<u4").tobytes().decode("utf-32-le")
    return [out[k : k + width] for k in range(0, n * width, width)]


def mask_unaligned(rows: DataFrame) -> DataFrame:
    """(aln, row, seq) with masked rows; an alignment is solved in one task, and null names are one alignment."""

    def kernel(group: pa.Table) -> list:
        return [group.column("aln"), group.column("row"), pa.array(unaligned(group.column("seq").to_pylist()), pa.string())]

    own = rows.select(F.col("aln").cast("long").alias("aln"), F.col("row").cast("long").alias("row"), "seq")
    return by_group(own, "aln", ["row"], kernel, "aln long, row long, seq string")


def best_runs(labels: list[int], least: int) -> list[tuple[int, int, int]]:
    """(begin, end, label) of runs over positions 1..n; the shortest run under ``least`` falls and equal neighbours join, until none is left."""
    runs: list[list[int]] = []
    for i, x in enumerate(labels, 1):
        if runs and runs[-1][2] == x:
            runs[-1][1] = i
        else:
            runs.append([i, i, x])
    while len(runs) > 1:
        at = min(range(len(runs)), key=lambda k: (runs[k][1] - runs[k][0], k))
        if runs[at][1] - runs[at][0] + 1 >= least:
            break
        runs.pop(at)
        if 0 < at < len(runs) and runs[at - 1][2] == runs[at][2]:
            runs[at - 1][1] = runs.pop(at)[1]
    return [tuple(r) for r in runs]


def best_chromosomes(aln: DataFrame, least: int) -> DataFrame:
    """(acc, chr, beg, end, segment): long runs of each genome's direction along the axis (0 forward, 1 inverted)."""

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pan")
        pan = pdf.pan.tolist()
        found = best_runs((pdf.own < 0).astype(int).tolist(), least)
        return pd.DataFrame([(pdf.acc.iloc[0], pdf.chr.iloc[0], pan[b - 1], pan[e - 1], x) for b, e, x in found], columns=["acc", "chr", "beg", "end", "segment"])

    return aln.groupBy("acc", "chr").applyInPandas(kernel, "acc long, chr long, beg long, end long, segment long")
