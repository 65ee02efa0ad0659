"""Clusterings as trees, alignments of alignments, and refinement of an alignment along its tree.

A group (alignment, locus) is solved in one task: its members are at most ``LEAVES`` where a table of all pairs is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.functions.dynamic import whole
from seqloom.operators.kernels import remembered, star, word_distances
from seqloom.plans import groups
from seqloom.plans.groups import by_group, sorted_groups

#: Members of a clustering, at most; a table of their distances takes 8 bytes a pair.
LEAVES = 4096


# --- trees ----------------------------------------------------------------------------------------
def linkage(d: np.ndarray) -> list[tuple[int, int, float, int]]:
    """(left, right, height, size) of each merge under complete linkage, nearest first; merge k makes node n + k.

    Of equal distances the pair with the smaller numbers merges first, where a cluster counts as its smallest
    leaf.  Left is the leaf with the smaller number, a leaf before a cluster, the earlier of two clusters.
    """
    n = len(d)
    d = d.astype(np.float64).copy()
    np.fill_diagonal(d, np.inf)
    node, size, alive = list(range(n)), [1] * n, np.ones(n, dtype=bool)
    near = d.argmin(axis=1) if n > 1 else np.zeros(n, dtype=np.int64)
    least = d[np.arange(n), near] if n > 1 else np.full(n, np.inf)
    out = []
    for k in range(n - 1):
        i = int(np.argmin(least))
        j = int(near[i])
        i, j, height = min(i, j), max(i, j), float(least[i])
        left, right = sorted((node[i], node[j]))
        size[i] += size[j]
        out.append((left, right, height, size[i]))
        node[i], alive[j] = n + k, False
        joined = np.maximum(d[i], d[j])
        joined[~alive] = np.inf
        joined[i] = np.inf
        d[i], d[:, i], d[j], d[:, j] = joined, joined, np.inf, np.inf
        least[j] = np.inf
        # Rows whose nearest was one of the two look again; distances only grow.
        for r in [i, *np.flatnonzero(alive & ((near == i) | (near == j))).tolist()]:
            near[r] = int(np.argmin(d[r]))
            least[r] = d[r, near[r]]
    return out


def leaves(merges: list[tuple[int, int, float, int]]) -> list[int]:
    """The leaves from left to right."""
    n = len(merges) + 1
    out, wait = [], [n + len(merges) - 1 if merges else 0]
    while wait:
        x = wait.pop()
        if x < n:
            out.append(x)
        else:
            wait += [merges[x - n][1], merges[x - n][0]]
    return out


def cut_at(merges: list[tuple[int, int, float, int]], height: float) -> list[int]:
    """Each leaf's cluster once the merges up to ``height`` are made, named by its smallest leaf."""
    n = len(merges) + 1
    label, first = list(range(n)), list(range(n)) + [0] * len(merges)
    for k, (a, b, h, _) in enumerate(merges):
        x, y = first[a], first[b]
        first[n + k] = min(x, y)
        if h <= height:
            label = [min(x, y) if c in (x, y) else c for c in label] if x in label and y in label else label
    return label


def _trees(distances: DataFrame, made, schema: str) -> DataFrame:
    """``made(rows, merges)`` gives the columns after aln of each group of (aln, i, j, d); a pair that is missing is infinitely far."""
    kind = distances.schema["aln"].dataType.simpleString()
    names = ["aln", *[x.split()[0] for x in schema.split(", ")]]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches):
            i, j, d = (group.column(k).to_numpy() for k in (1, 2, 3))
            rows = np.unique(np.concatenate((i, j)))
            if len(rows) > LEAVES:
                raise ValueError(f"a clustering has {len(rows)} members; at most {LEAVES} are clustered")
            table = np.full((len(rows), len(rows)), np.inf)
            a, b = np.searchsorted(rows, i), np.searchsorted(rows, j)
            table[a, b] = table[b, a] = d
            cols = made(rows, linkage(table))
            yield pa.RecordBatch.from_arrays([pa.array([group.column(0)[0].as_py()] * len(cols[0]), group.column(0).type), *[pa.array(c) for c in cols]], names)

    own = distances.select("aln", F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("d").cast("double").alias("d")).where("d IS NOT NULL AND aln IS NOT NULL")
    return groups.spread(own, "aln").sortWithinPartitions("aln").mapInArrow(kernel, f"aln {kind}, {schema}")


def dendrogram(distances: DataFrame) -> DataFrame:
    """(aln, step, left, right, height, size): complete linkage of the rows of (aln, i, j, d) as an edge table.

    ``left`` and ``right`` are rows, or -k for what step k made; steps count from 1.  Groups of over LEAVES rows raise.
    """

    def made(rows: np.ndarray, merges: list) -> list:
        n = len(rows)
        name = lambda x: int(rows[x]) if x < n else -(x - n + 1)
        return [np.arange(1, n), np.array([name(m[0]) for m in merges], dtype=np.int64), np.array([name(m[1]) for m in merges], dtype=np.int64), np.array([m[2] for m in merges]), np.array([m[3] for m in merges], dtype=np.int64)]

    return _trees(distances, made, "step long, left long, right long, height double, size long")


def leaf_order(distances: DataFrame) -> DataFrame:
    """(aln, row, place): the rows from left to right under their tree, places from 1."""
    return _trees(distances, lambda rows, merges: [rows[leaves(merges)], np.arange(1, len(rows) + 1)], "row long, place long")


def linkage_clusters(distances: DataFrame, height: float) -> DataFrame:
    """(aln, row, cluster): clusters whose rows are all at most ``height`` apart, named by their first row."""
    return _trees(distances, lambda rows, merges: [rows, rows[cut_at(merges, height)]], "row long, cluster long")


# --- alignments of alignments ---------------------------------------------------------------------
_KINDS = np.full(256, 5, dtype=np.int64)
for _k, _c in enumerate("ACGT"):
    _KINDS[[ord(_c), ord(_c.lower())]] = _k
_KINDS[codes.GAP] = 4
#: Two symbols score this much if they are equal and its negative if not; a gap costs OPENING of it, and EXTENSION a column.
MATCH, OPENING, EXTENSION = 1000, 3000, 100


def shares(rows: list[str]) -> np.ndarray:
    """(columns, 5): how many of the rows have A, C, G, T or another symbol in each column, as shares."""
    if not rows:
        return np.zeros((0, 5))
    kinds = _KINDS[np.array([codes.symbols(r) for r in rows])]
    return np.stack([(kinds == k).mean(axis=0) for k in (0, 1, 2, 3, 5)], axis=1)


def merged(one: list[str], two: list[str]) -> str:
    """The path that aligns all columns of two alignments: two columns score the mean over pairs of their rows, gaps count as nothing."""
    a, b = shares(one), shares(two)
    same = np.full((5, 5), -1.0)
    same[[0, 1, 2, 3], [0, 1, 2, 3]] = 1.0
    weighed = (same @ b.T) * MATCH
    return whole(lambda i: np.rint(a[i] @ weighed).astype(np.int64), len(a), len(b), OPENING, EXTENSION)[1]


def spread(rows: list[str], path: str, mine: str) -> list[str]:
    """The rows with a gap column wherever ``path`` takes a column of the other alignment alone."""
    keep = np.frombuffer(path.encode(), dtype=np.uint8) != ord("B" if mine == "A" else "A")
    out = np.full((len(rows), len(path)), codes.GAP, dtype=np.uint8)
    if rows:
        out[:, keep] = np.array([codes.symbols(r) for r in rows])
    return [r.tobytes().decode() for r in out]


def runs(path: str, apart: int) -> list[tuple[int, int]]:
    """(begin, past) of the runs of columns of both alignments; runs with fewer than ``apart`` columns between them are one."""
    both = np.frombuffer(path.encode(), dtype=np.uint8) == ord("M")
    edges = np.flatnonzero(np.diff(both, prepend=False, append=False))
    out: list[list[int]] = []
    for b, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if out and b - out[-1][1] < apart:
            out[-1][1] = e
        else:
            out.append([b, e])
    return [tuple(x) for x in out]


def supported(one: list[str], two: list[str], path: str, apart: int = 8, shortest: int = 25, least: float = 0.8) -> str:
    """``path`` with the columns of what has no support side by side.

    A run of columns of both (at most ``apart`` columns of one between them) is supported if the consensus symbols agree in ``least``
    of its columns of both; runs between others are not if they are shorter than ``shortest`` and than a third of either.
    """
    a, b = shares(one), shares(two)
    n = np.cumsum([0, *[x != "B" for x in path]])
    m = np.cumsum([0, *[x != "A" for x in path]])
    found = runs(path, apart + 1)
    short = min(len(a) / 3, len(b) / 3, shortest)
    out, at = [], 0

    def loose(upto: int) -> None:
        part = path[at:upto]
        if "M" in part:
            part = "A" * (len(part) - part.count("B")) + "B" * (len(part) - part.count("A"))
        out.append(part)

    for k, (lo, hi) in enumerate(found):
        if 0 < k < len(found) - 1 and hi - lo < short:
            continue
        at_both = [c for c in range(lo, hi) if path[c] == "M"]
        same = sum(int(a[n[c]].argmax() == b[m[c]].argmax()) for c in at_both)
        if same >= least * len(at_both):
            loose(lo)
            out.append(path[lo:hi])
            at = hi
    loose(len(path))
    return "".join(out)


def merged_profiles(rows: DataFrame) -> DataFrame:
    """(id, side, row, aligned): two alignments (id, side 1 or 2, row, seq) of each id as one; a side that is missing leaves the other as it is.

    Rows of a side have one length, or this raises.
    """

    def kernel(group: pa.Table) -> list:
        side, seq = group.column("side").to_pylist(), group.column("seq").to_pylist()
        one, two = ([q for q, k in zip(seq, side, strict=True) if k == s] for s in (1, 2))
        path = merged(one, two)
        return [group.column("id"), group.column("side"), group.column("row"), pa.array(spread(one, path, "A") + spread(two, path, "B"), pa.string())]

    own = rows.select("id", F.col("side").cast("long").alias("side"), F.col("row").cast("long").alias("row"), F.coalesce("seq", F.lit("")).alias("seq"))
    return by_group(own, "id", ["side", "row"], kernel, f"id {rows.schema['id'].dataType.simpleString()}, side long, row long, aligned string")


def shared_blocks(merged_rows: DataFrame, apart: int = 5) -> DataFrame:
    """(id, beg1, end1, beg2, end2, length): runs of columns that both sides of ``merged_profiles`` have, at most ``apart`` apart glued, as columns of either."""

    def kernel(group: pa.Table) -> list:
        aligned = group.column("aligned").to_pylist()
        here = [np.zeros(len(aligned[0]), dtype=bool) for _ in range(2)]
        for side, text in zip(group.column("side").to_pylist(), aligned, strict=True):
            here[side - 1] |= codes.symbols(text) != codes.GAP
        path = "".join("M" if p and q else "A" if p else "B" for p, q in zip(*[h.tolist() for h in here], strict=True))
        n, m = np.cumsum(here[0]), np.cumsum(here[1])
        found = [(n[lo], n[hi - 1], m[lo], m[hi - 1], hi - lo) for lo, hi in runs(path, apart)]
        cols = np.array(found, dtype=np.int64).reshape(-1, 5).T
        return [pa.array([group.column("id")[0].as_py()] * len(found), group.column("id").type), *[pa.array(c) for c in cols]]

    return by_group(merged_rows, "id", ["side", "row"], kernel, f"id {merged_rows.schema['id'].dataType.simpleString()}, beg1 long, end1 long, beg2 long, end2 long, length long")


# --- refinement -----------------------------------------------------------------------------------
def refined(seqs: list[str], height: float = 0.1, size: int = 7) -> list[str]:
    """An alignment of all sequences: clusters of near ones are aligned, then merged along their tree; what has no support stands side by side."""
    here = [k for k, s in enumerate(seqs) if s]
    if not here:
        return list(seqs)
    own = [seqs[k] for k in here]
    merges = linkage(word_distances(own, size))
    label = cut_at(merges, height)
    held: dict[int, tuple[list[int], list[str]]] = {}
    for c in sorted(set(label)):
        who = [k for k, x in enumerate(label) if x == c]
        held[c] = (who, star([own[k] for k in who]))
    n = len(own)
    name = list(range(n)) + [0] * len(merges)
    name[:n] = label
    for k, (a, b, _, _) in enumerate(merges):
        x, y = name[a], name[b]
        name[n + k] = x
        if x == y:
            continue
        (one, p), (two, q) = held[x], held.pop(y)
        path = supported(p, q, merged(p, q))
        held[x] = (one + two, spread(p, path, "A") + spread(q, path, "B"))
    (who, rows), = held.values()
    width = len(rows[0])
    out = ["-" * width] * len(seqs)
    for k, r in zip(who, rows, strict=True):
        out[here[k]] = r
    return out


@remembered
def refined_once(*seqs: str, height: float) -> list[str]:
    return refined(list(seqs), height)


def refined_alignments(rows: DataFrame, height: float = 0.1) -> DataFrame:
    """(id, row, aligned): the sequences (id, row, seq) of each locus aligned anew; gaps in them are dropped first, null and empty ones get gaps alone."""

    def kernel(group: pa.Table) -> list:
        seqs = [s.replace("-", "").upper() for s in group.column("seq").to_pylist()]
        return [group.column("id"), group.column("row"), pa.array(refined_once(*seqs, height=height), pa.string())]

    own = rows.select("id", F.col("row").cast("long").alias("row"), F.coalesce("seq", F.lit("")).alias("seq"))
    return by_group(own, "id", ["row", "seq"], kernel, f"id {rows.schema['id'].dataType.simpleString()}, row long, aligned string")
