"""Gapped extension of alignments over arrays: rows of an affine table, cut where the score has dropped too far."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np

NONE = -(1 << 40)


def _room(a: np.ndarray, scores: np.ndarray, opening: int, extension: int, drop: int) -> int:
    """How many symbols of the other sequence an extension of ``a`` can use: what is longer costs more gaps than all pairs can win."""
    won = int(np.maximum(scores.max(axis=1), 0)[a].sum())
    return len(a) + 1 + max(0, (won + drop - opening) // extension)


def extend(a: np.ndarray, b: np.ndarray, scores: np.ndarray, opening: int, extension: int, drop: int) -> tuple[int, int, int, str]:
    """(score, i, j, path): the best alignment of ``a[:i]`` with ``b[:j]`` from their begin; a gap of n costs opening + n * extension.

    Cells at both ends of a row that are over ``drop`` below the best so far are left.  ``path`` has M for a
    pair, A for a symbol of ``a`` alone and B for one of ``b`` alone.  Equal scores: the shorter ``i``, then ``j``.
    """
    reach = max(0, (drop - opening) // extension)
    b = b[: _room(a, scores, opening, extension, drop)]
    best, best_i, best_j = 0, 0, 0
    lo = 0
    h = np.zeros(min(len(b), reach) + 1, dtype=np.int64)
    h[1:] = -opening - extension * np.arange(1, len(h))
    v = np.full(len(h), NONE)
    # Few calls a row: rows are short, so that calls are what they cost.  Scores and ramps are cut from tables.
    won = scores[:, b]
    room = len(b) + 2
    ramp, none = extension * np.arange(room), np.full(room, NONE)
    opened = ramp[1:] + opening
    opens = opening + extension
    kept = []  # (first column, row before its gaps in a, what pairs win, what gaps in b go on, what ends in a gap in a)
    for i, x in enumerate(a.tolist(), 1):
        m = len(h)
        n = min(len(b) - lo + 1, m + 1 + reach)
        k = min(n, m)
        up, on = h[:k] - opens, v[:k] - extension
        going = on > up
        v = none[:n].copy()
        v[:k] = np.maximum(up, on)
        t = v.copy()
        k = min(n - 1, m)
        pair = h[:k] + won[x, lo : lo + k]
        paired = pair >= v[1 : k + 1]
        t[1 : k + 1] = np.maximum(pair, t[1 : k + 1])
        h = t.copy()
        side = np.maximum.accumulate(t + ramp[:n])[:-1] - opened[: n - 1]
        sided = side > t[1:]
        h[1:] = np.maximum(t[1:], side)
        at = int(h.argmax())
        top = int(h[at])
        if top > best:
            best, best_i, best_j = top, i, lo + at
        live = (h >= best - drop).nonzero()[0]
        if not len(live):
            break
        first, last = int(live[0]), int(live[-1]) + 1
        kept.append((lo, t, paired, going, sided))
        lo, h, v = lo + first, h[first:last], v[first:last]
    path = []
    i, j, gap = best_i, best_j, False
    while i or j:
        if not i:
            path.append("B" * j)
            break
        begin, t, paired, going, sided = kept[i - 1]
        c = j - begin
        if not gap and c and sided[c - 1]:
            # The gap began at the nearest cell that gives its score.
            ramp = extension * np.arange(c)
            value = t[:c] + ramp
            k = c - 1 - int(np.argmax(value[::-1]))
            path.append("B" * (c - k))
            j = begin + k
            c = k
        if not gap and c and paired[c - 1]:
            path.append("M")
            i, j = i - 1, j - 1
        else:
            path.append("A")
            gap = bool(going[c])
            i -= 1
    return best, best_i, best_j, "".join(path)[::-1]


def strings(a: str, b: str, path: str) -> tuple[str, str]:
    """Both sequences with gaps along ``path``."""
    out_a, out_b, i, j = [], [], 0, 0
    for step, n in pieces(path):
        out_a.append(a[i : i + n] if step != "B" else "-" * n)
        out_b.append(b[j : j + n] if step != "A" else "-" * n)
        i += n if step != "B" else 0
        j += n if step != "A" else 0
    return "".join(out_a), "".join(out_b)


def pieces(path: str) -> Iterator[tuple[str, int]]:
    """(step, n): the runs of equal steps of a path, in order."""
    return ((step, len(list(run))) for step, run in groupby(path))


def through(a: np.ndarray, b: np.ndarray, x: int, y: int, size: int, scores: np.ndarray, opening: int, extension: int, drop: int) -> tuple[int, int, int, str]:
    """(score, begin in a, begin in b, path) of the alignment grown to both sides of a seed of ``size`` pairs at (x, y)."""
    left, i, j, back = extend(a[:x][::-1], b[:y][::-1], scores, opening, extension, drop)
    right, _, _, on = extend(a[x + size :], b[y + size :], scores, opening, extension, drop)
    own = int(scores[a[x : x + size], b[y : y + size]].sum())
    return left + own + right, x - i, y - j, back[::-1] + "M" * size + on


def extend_scores(a: list[np.ndarray], b: list[np.ndarray], scores: np.ndarray, opening: int, extension: int, drop: int) -> np.ndarray:
    """The scores that ``extend`` gives for each pair, for all pairs together, a row at a time."""
    best = np.zeros(len(a), dtype=np.int64)
    n, m = np.array([len(x) for x in a]), np.array([len(y) for y in b])
    if not len(a) or not n.max():
        return best
    low, none = -(1 << 29), len(scores)
    won = np.pad(scores, ((0, 0), (0, 1)), constant_values=low // 2).astype(np.int32)  # one more symbol stands behind each end
    x, y = np.zeros((len(a), n.max()), dtype=np.uint8), np.full((len(a), m.max()), none, dtype=np.uint8)
    for k, (p, q) in enumerate(zip(a, b, strict=True)):
        x[k, : len(p)], y[k, : len(q)] = p, q
    reach = max(0, (drop - opening) // extension)
    ramp = extension * np.arange(m.max() + 1, dtype=np.int32)
    at = np.flatnonzero(n > 0)
    h = np.full((len(at), m.max() + 1), low, dtype=np.int32)
    h[:, 1 : reach + 1] = -opening - ramp[1 : reach + 1]
    h[:, 0] = 0
    v = np.full(h.shape, low, dtype=np.int32)
    lo, hi = 0, min(reach + 1, m.max() + 1)  # the columns that some pair still uses
    for i in range(n.max()):
        on = n[at] > i
        if not on.all():
            at, h, v = at[on], h[on], v[on]
        hi = min(hi + 1 + reach, m.max() + 1)
        old = h[:, lo:hi]
        up = np.maximum(old - (opening + extension), v[:, lo:hi] - extension)
        t = up.copy()
        np.maximum(t[:, 1:], old[:, :-1] + won[x[at, i][:, None], y[at, lo : hi - 1]], out=t[:, 1:])
        new = t.copy()
        np.maximum(new[:, 1:], np.maximum.accumulate(t + ramp[: hi - lo], axis=1)[:, :-1] - ramp[1 : hi - lo] - opening, out=new[:, 1:])
        best[at] = np.maximum(best[at], new.max(axis=1))
        live = new >= (best[at] - drop)[:, None]
        first, last = live.argmax(axis=1), hi - lo - live[:, ::-1].argmax(axis=1)
        place = np.arange(hi - lo)
        out = (place < first[:, None]) | (place >= last[:, None])
        new[out] = up[out] = low
        h[:, lo:hi], v[:, lo:hi] = new, up
        on = live.any(axis=1)
        if not on.all():
            at, h, v, first, last = at[on], h[on], v[on], first[on], last[on]
        if not len(at):
            break
        lo, hi = lo + int(first.min()), lo + int(last.max())
    return best


#: Rows of all pairs together that are kept for the ways back, where pairs go on beyond the first rows.
KEPT = 1 << 17


def extend_all(a: list[np.ndarray], b: list[np.ndarray], scores: np.ndarray, opening: int, extension: int, drop: int, rows: int = 256) -> list[tuple[int, int, int, str]]:
    """What ``extend`` gives for each pair, for all pairs together, a row at a time; pairs that go on beyond ``rows`` rows begin again in smaller parts."""
    count, low, none = len(a), -(1 << 29), len(scores)
    n = np.minimum([len(p) for p in a], rows)
    # A cell farther right cannot be reached in so many rows.
    width = rows + 1 + max(0, rows * max(0, int(scores.max())) + drop - opening) // extension
    m = np.minimum([len(q) for q in b], width)
    best, best_i, best_j = (np.zeros(count, dtype=np.int64) for _ in range(3))
    x, y = np.zeros((count, int(n.max(initial=0))), dtype=np.uint8), np.full((count, int(m.max(initial=0)) + 1), none, dtype=np.uint8)
    for k, (p, q) in enumerate(zip(a, b, strict=True)):
        x[k, : n[k]], y[k, : m[k]] = p[: n[k]], q[: m[k]]
    won = np.pad(scores, ((0, 0), (0, 1)), constant_values=low // 2).astype(np.int32)
    reach = max(0, (drop - opening) // extension)
    columns = y.shape[1]
    place, ramp = np.arange(columns), extension * np.arange(columns, dtype=np.int32)
    at = np.flatnonzero(n > 0)
    h = np.full((len(at), columns), low, dtype=np.int32)
    h[:, 1 : reach + 1] = -opening - ramp[1 : reach + 1]
    h[:, 0] = 0
    h[place > m[at][:, None]] = low
    v = np.full(h.shape, low, dtype=np.int32)
    lo, hi = 0, min(reach + 1, columns)  # the columns that some pair still uses
    kept = []
    for i in range(x.shape[1]):
        on = n[at] > i
        if not on.all():
            at, h, v = at[on], h[on], v[on]
        if not len(at):
            break
        hi = min(hi + 1 + reach, columns)
        old = h[:, lo:hi]
        up, on = old - (opening + extension), v[:, lo:hi] - extension
        going = on > up
        gaps = np.maximum(up, on)
        t = gaps.copy()
        pair = old[:, :-1] + won[x[at, i][:, None], y[at, lo : hi - 1]]
        paired = pair >= gaps[:, 1:]
        np.maximum(t[:, 1:], pair, out=t[:, 1:])
        side = np.maximum.accumulate(t + ramp[: hi - lo], axis=1)[:, :-1] - (ramp[1 : hi - lo + 1][: hi - lo - 1] + opening)
        sided = side > t[:, 1:]
        new = t.copy()
        np.maximum(new[:, 1:], side, out=new[:, 1:])
        beyond = place[lo:hi] > m[at][:, None]
        new[beyond] = low
        kept.append((at, lo, t, paired, going, sided))
        top = new.argmax(axis=1)
        value = new[np.arange(len(at)), top]
        more = value > best[at]
        best[at[more]], best_i[at[more]], best_j[at[more]] = value[more], i + 1, lo + top[more]
        live = new >= (best[at] - drop)[:, None]
        first, last = live.argmax(axis=1), hi - lo - live[:, ::-1].argmax(axis=1)
        out = (place[: hi - lo] < first[:, None]) | (place[: hi - lo] >= last[:, None])
        new[out] = gaps[out] = low
        h[:, lo:hi], v[:, lo:hi] = new, gaps
        on = live.any(axis=1)
        if not on.all():
            at, h, v, first, last = at[on], h[on], v[on], first[on], last[on]
        if not len(at):
            break
        lo, hi = lo + int(first.min()), lo + int(last.max())
    # Longer ones go on in smaller parts with more rows each, the longest alone.
    rest, deeper, out = [k for k in at.tolist() if len(a[k]) > rows], 8 * rows, {}
    part = KEPT // deeper
    for lo in range(0, len(rest), max(1, part)):
        some = rest[lo : lo + max(1, part)]
        if len(some) < 3:
            out.update((k, extend(a[k], b[k], scores, opening, extension, drop)) for k in some)
        else:
            out.update(zip(some, extend_all([a[k] for k in some], [b[k] for k in some], scores, opening, extension, drop, deeper), strict=True))
    for k in range(count):
        if k not in out:
            out[k] = int(best[k]), int(best_i[k]), int(best_j[k]), _way_back(kept, k, int(best_i[k]), int(best_j[k]), extension)
    return [out[k] for k in range(count)]


def _way_back(kept: list[tuple], k: int, i: int, j: int, extension: int) -> str:
    """The path of pair ``k`` to its cell (i, j) through the rows that ``extend_all`` kept."""
    path, gap = [], False
    while i or j:
        if not i:
            path.append("B" * j)
            break
        at, begin, t, paired, going, sided = kept[i - 1]
        r = int(np.searchsorted(at, k))
        c = j - begin
        if not gap and c and sided[r, c - 1]:
            # The gap began at the nearest cell that gives its score.
            value = t[r, :c] + extension * np.arange(c)
            past = c - 1 - int(np.argmax(value[::-1]))
            path.append("B" * (c - past))
            j = begin + past
            c = past
        if not gap and c and paired[r, c - 1]:
            path.append("M")
            i, j = i - 1, j - 1
        else:
            path.append("A")
            gap = bool(going[r, c])
            i -= 1
    return "".join(path)[::-1]


def through_all(a: np.ndarray, b: np.ndarray, starts: list[tuple[int, int, int]], scores: np.ndarray, opening: int, extension: int, drop: int) -> list[tuple[int, int, int, str]]:
    """What ``through`` gives for the seeds (x, y, size) of one pair of sequences, grown together."""
    if len(starts) < 3:
        return [through(a, b, x, y, n, scores, opening, extension, drop) for x, y, n in starts]
    sides = [(a[:x][::-1], b[:y][::-1]) for x, y, _ in starts] + [(a[x + n :], b[y + n :]) for x, y, n in starts]
    found = extend_all([p for p, _ in sides], [q for _, q in sides], scores, opening, extension, drop)
    out = []
    for (x, y, n), (left, i, j, back), (right, _, _, on) in zip(starts, found[: len(starts)], found[len(starts) :], strict=True):
        own = int(scores[a[x : x + n], b[y : y + n]].sum())
        out.append((left + own + right, x - i, y - j, back[::-1] + "M" * n + on))
    return out


def through_scores(starts: list[tuple[np.ndarray, np.ndarray, int, int]], size: int, scores: np.ndarray, opening: int, extension: int, drop: int, cells: int = 1 << 22) -> list[int]:
    """The scores that ``through`` gives for starts (a, b, x, y); some ``cells`` of tables are held at a time."""
    sides = []
    for a, b, x, y in starts:
        for p, q in ((a[:x][::-1], b[:y][::-1]), (a[x + size :], b[y + size :])):
            sides.append((p, q[: _room(p, scores, opening, extension, drop)]))
    out = np.zeros(len(sides), dtype=np.int64)
    order = sorted(range(len(sides)), key=lambda k: len(sides[k][1]))
    while order:
        n = max(1, cells // (len(sides[order[-1]][1]) + 1))
        part, order = order[-n:], order[:-n]
        out[part] = extend_scores([sides[k][0] for k in part], [sides[k][1] for k in part], scores, opening, extension, drop)
    own = [int(scores[a[x : x + size], b[y : y + size]].sum()) for a, b, x, y in starts]
    return (out.reshape(-1, 2).sum(axis=1) + np.array(own, dtype=np.int64)).tolist()


def whole(score: Callable[[int], np.ndarray], n: int, m: int, opening: int, extension: int) -> tuple[int, str]:
    """(score, path) of the best alignment of all ``n`` with all ``m`` places; ``score(i)`` is the row of place ``i``'s scores with each of the others.

    A gap of k costs opening + k * extension.  One byte a cell is kept.
    """
    ramp = extension * np.arange(m + 1)
    side = -opening - ramp
    h = side.copy()
    h[0], side[0] = 0, NONE
    v = np.full(m + 1, NONE)
    flags = np.zeros((n + 1, m + 1), dtype=np.uint8)
    for i in range(1, n + 1):
        up, on = h - opening - extension, v - extension
        pair = np.full(m + 1, NONE)
        pair[1:] = h[:-1] + score(i - 1)
        v = np.maximum(up, on)
        t = np.maximum(pair, v)
        side = np.full(m + 1, NONE)
        side[1:] = np.maximum.accumulate(t + ramp)[:-1] - ramp[1:] - opening
        flags[i] = (pair >= v) | (on > up) * np.uint8(2) | (side > t) * np.uint8(4)
        flags[i, 1:] |= (side[1:] > t[:-1] - opening - extension) * np.uint8(8)
        h = np.maximum(t, side)
    path, i, j, state = [], n, m, ""
    while i or j:
        cell = flags[i, j]
        if not i or state == "B" or not state and cell & 4:
            path.append("B")
            state = "B" if cell & 8 else "T"  # T: what the gap began from, which is no such gap itself
            j -= 1
        elif state != "A" and cell & 1:
            path.append("M")
            i, j, state = i - 1, j - 1, ""
        else:
            path.append("A")
            state = "A" if cell & 2 else ""
            i -= 1
    return int(h[m]), "".join(path)[::-1]
