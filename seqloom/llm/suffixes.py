"""Suffix arrays of byte shards by induced sorting, with permuted common prefixes up to a width.

Suffixes are classified as smaller or larger than their followers; the leftmost smaller (LMS)
substrings are sorted by one induction, named, and the text of their names is sorted in turn, as
deep as names repeat; the order of its suffixes induces the order of all.  Induction is
linear in the text at every level over a small alphabet, bucket by bucket with arrays; over the large
alphabets of names the suffixes of a kind are sorted at once by their runs and by what these end in.
"""

from __future__ import annotations

import numpy as np


def kinds(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S-type); the last symbol is unique and least."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int32) - text[:-1])
    at = np.where(step != 0, np.arange(n - 1, dtype=np.int32), np.int32(n))
    nxt = np.minimum.accumulate(at[::-1])[::-1]  # where the symbols next differ
    out = np.ones(n, dtype=bool)
    out[:-1] = step[np.minimum(nxt, n - 2)] > 0
    return out


def _deal(items: np.ndarray, symbols: np.ndarray, queues: list[list[np.ndarray]]) -> None:
    """Append ``items`` to the queues of their symbols, in order."""
    if not len(items):
        return
    order = np.argsort(symbols, kind="stable")
    items, symbols = items[order], symbols[order]
    at = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for lo, hi in zip([0, *at.tolist()], [*at.tolist(), len(items)], strict=True):
        queues[symbols[lo]].append(items[lo:hi])


_NONE = np.zeros(0, dtype=np.int32)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else _NONE


def _by_buckets(text: np.ndarray, small: np.ndarray, heads: np.ndarray, size: int) -> np.ndarray:
    """``induce`` in waves: what a bucket induces in itself is its next wave."""
    large: list[list[np.ndarray]] = [[] for _ in range(size)]
    lms: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(heads, text[heads], lms)

    def before(items: np.ndarray, want_small: bool) -> np.ndarray:
        items = items[items > 0] - 1
        return items[small[items] == want_small]

    ups: list[np.ndarray] = []
    for c in range(size):
        done, wave = [], _joined(large[c])
        while len(wave):
            done.append(wave)
            wave = before(wave, False)
            symbols = text[wave]
            own = symbols == c
            _deal(wave[~own], symbols[~own], large)
            wave = wave[own]
        ups.append(_joined(done))
        found = before(_joined(lms[c]), False)
        _deal(found, text[found], large)
    queues: list[list[np.ndarray]] = [[] for _ in range(size)]
    out: list[np.ndarray] = [_NONE] * size
    for c in range(size - 1, -1, -1):
        done, wave = [], _joined(queues[c])
        while len(wave):
            done.append(wave)
            wave = before(wave, True)
            symbols = text[wave]
            own = symbols == c
            _deal(wave[~own], symbols[~own], queues)
            wave = wave[own]
        found = before(ups[c][::-1], True)
        _deal(found, text[found], queues)
        downs = _joined(done)[::-1] if c else np.array([len(text) - 1], dtype=np.int32)
        out[c] = np.concatenate((ups[c], downs))
    return np.concatenate(out)


def _by_runs(text: np.ndarray, small: np.ndarray, heads: np.ndarray, size: int) -> np.ndarray:
    """``induce`` with all suffixes of a kind at once: a suffix follows from its run, the suffixes of its kind up to the next one of the other, and that one's place."""
    n = len(text)
    symbol = text.astype(np.int64) * 2 + small  # of equal symbols the larger kind comes first
    place = np.zeros(n, dtype=np.int64)
    place[heads[np.argsort(text[heads], kind="stable")]] = np.arange(len(heads))
    larger = _ordered(symbol, np.flatnonzero(~small), _ends(~small), place, size)
    place[larger] = np.arange(len(larger))
    smaller = _ordered(symbol, np.flatnonzero(small[:-1]), _ends(small), place, size)
    out = np.empty(n, dtype=np.int32)
    out[0] = n - 1
    out[1 + np.arange(len(larger)) + np.searchsorted(text[smaller], text[larger], side="left")] = larger
    out[1 + np.arange(len(smaller)) + np.searchsorted(text[larger], text[smaller], side="right")] = smaller
    return out


def _ends(own: np.ndarray) -> np.ndarray:
    """Where the next suffix stands that is not ``own``, for each one."""
    at = np.where(own, len(own), np.arange(len(own)))
    return np.minimum.accumulate(at[::-1])[::-1]


def _ordered(symbol: np.ndarray, at: np.ndarray, ends: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    """The suffixes ``at`` in order, of which each run ends before ``ends``, where the suffixes are ordered by ``place``.

    Some symbols at a time are one number; runs that go on in the same way are told apart by the order of what follows, over twice the length each time.
    """
    bits = (2 * size - 1).bit_length()
    step = 63 // bits
    end = ends[at]
    key = np.zeros(len(at), dtype=np.int64)
    for k in range(step):
        key = (key << bits) | np.where(at + k <= end, symbol[np.minimum(at + k, end)], 0)
    tie = np.where(end - at < step, place[end] + 1, 0)
    order = np.lexsort((tie, key))
    at, key, tie = at[order], key[order], tie[order]
    # The rank of a group of equals is where it begins.
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (tie[1:] != tie[:-1])))[: len(at)]
    first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    rank = np.zeros(len(symbol), dtype=np.int64)
    rank[at] = first
    equal = ~new
    equal[:-1] |= ~new[1:]
    left = np.flatnonzero(equal)
    while len(left):
        own, group = at[left], first[left]
        follow = own + step
        known = np.where(ends[own] == follow, place[follow], rank[follow])
        order = np.lexsort((known, symbol[follow], group))
        own, group, known, follow = own[order], group[order], known[order], follow[order]
        at[left] = own
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (symbol[follow[1:]] != symbol[follow[:-1]]) | (known[1:] != known[:-1])))
        first[left] = left[np.maximum.accumulate(np.where(new, np.arange(len(left)), 0))]
        rank[own] = first[left]
        equal = ~new
        equal[:-1] |= ~new[1:]
        left, step = left[equal], 2 * step
    return at


#: Alphabets up to this size are induced bucket by bucket.
BUCKETS = 512


def induce(text: np.ndarray, small: np.ndarray, heads: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, from the leftmost S-type ones ``heads`` in order.

    The larger (L-type) suffixes follow from a scan upwards and the S-type ones from a scan
    downwards.
    """
    return (_by_buckets if size <= BUCKETS else _by_runs)(text, small, heads, size)


def _names(text: np.ndarray, heads: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """The rank of each leftmost S-type substring, by text position; equal substrings share one."""
    ends = np.append(heads[1:], len(text) - 1)
    length = np.zeros(len(text), dtype=np.int32)
    length[heads] = ends - heads + 1
    a, b = ordered[:-1], ordered[1:]
    differ = length[a] != length[b]
    live, k = np.flatnonzero(~differ), 0
    while len(live):
        live = live[length[a[live]] > k]
        off = text[a[live] + k] != text[b[live] + k]
        differ[live[off]] = True
        live, k = live[~off], k + 1
    rank = np.zeros(len(text), dtype=np.int32)
    rank[ordered] = np.concatenate(([0], np.cumsum(differ)))
    return rank[heads]


def suffix_array(text: np.ndarray, size: int, levels: list | None = None) -> np.ndarray:
    """The suffixes of ``text`` (symbols under ``size``, the last one 0 and unique) in order.

    Length and alphabet of the text of each level are added to ``levels``.
    """
    if levels is not None:
        levels.append((len(text), size))
    if len(text) == 1:
        return np.zeros(1, dtype=np.int64)
    small = kinds(text)
    heads = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    ordered = induce(text, small, heads, size)
    is_head = np.zeros(len(text), dtype=bool)
    is_head[heads] = True
    ordered = ordered[is_head[ordered]]
    names = _names(text, heads, ordered)
    count = int(names.max()) + 1
    if count < len(heads):
        ordered = heads[suffix_array(names, count, levels)]
    return induce(text, small, ordered, size)


def common(data: np.ndarray, order: np.ndarray, room: np.ndarray, width: int) -> np.ndarray:
    """Permuted common prefixes: for each text position, how many bytes, at most ``width``, it shares with its predecessor in ``order``.

    ``room`` gives the bytes from each position to the end of its piece, where every prefix ends;
    ``data`` holds ``width`` + 8 more bytes than positions.
    """
    before = np.full(len(order), -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(order), dtype=np.int32)
    at = np.flatnonzero((before >= 0) & (room > 0)).astype(np.int32)
    eight = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), 0, (1,))
    for k in range(0, width, 8):
        x = eight[at + k] ^ eight[before[at] + k]
        off = np.flatnonzero(x)
        lowest = x[off] & (~x[off] + np.uint64(1))
        out[at[off]] = k + (np.log2(lowest.astype(np.float64)) // 8).astype(np.int32)
        at = at[x == 0]
    out[at] = width
    return np.minimum(out, np.minimum(np.minimum(room, room[before]), width))


def repeated(pieces: list[bytes], width: int) -> np.ndarray:
    """Over the joined ``pieces`` (one byte between them): starts of ``width`` bytes in one piece that also start earlier."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    joined = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
    n = len(joined)
    text = joined.astype(np.int16) + 2
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 1
    text = np.append(text, np.int16(0))
    room = np.zeros(n + 1, dtype=np.int32)
    room[:n] = np.repeat(ends, sizes + 1) - np.arange(n)
    order = suffix_array(text, 258)
    lcp = common(np.append(joined, np.zeros(width + 9, np.uint8)), order, room, width)
    group = np.cumsum(lcp[order] < width)
    first = np.flatnonzero(np.diff(group, prepend=0))
    least = np.repeat(np.minimum.reduceat(order, first), np.diff(np.append(first, len(order))))
    out = np.zeros(n + 1, dtype=bool)
    out[order] = order != least
    return out[:n] & (room[:n] >= width)
