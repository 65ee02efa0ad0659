"""Sequence functions over bytes: Arrow kernels for what JVM expressions could only do symbol by symbol.

Sequences are ASCII; a symbol beyond that counts as one unknown symbol.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from seqloom.functions.alphabet import AMINO, BASES, IUPAC, PAIRED

GAP = ord("-")
_CODE = np.full(256, 64, dtype=np.uint16)
for _i, _b in enumerate(BASES):
    _CODE[[ord(_b), ord(_b.lower())]] = _i
_AMINO = np.frombuffer((AMINO + "-").encode(), dtype=np.uint8)
_PAIR = np.full(256, ord("N"), dtype=np.uint8)
for _a, _b in zip(IUPAC, PAIRED, strict=True):
    _PAIR[[ord(_a), ord(_a.lower())]] = ord(_b)


def symbols(text: str) -> np.ndarray:
    """One byte for each symbol."""
    return np.frombuffer(text.encode("ascii", "replace"), dtype=np.uint8)


def codons(codes: np.ndarray, shift: int = 0) -> np.ndarray:
    """Amino acids (ASCII) of the codons of base codes from ``shift`` on; an unknown codon is ``-``."""
    n = (len(codes) - shift) // 3
    c = codes[shift : shift + 3 * max(n, 0)]
    return _AMINO[np.minimum(c[0::3] * 16 + c[1::3] * 4 + c[2::3], 64)]


def base_codes(seq: np.ndarray) -> np.ndarray:
    return _CODE[seq]


def opposite(seq: np.ndarray) -> np.ndarray:
    """The reverse complement; unknown symbols become N."""
    return _PAIR[seq][::-1]


def amino(text: str) -> str:
    return codons(_CODE[symbols(text)]).tobytes().decode()


def repeated_share(text: str, size: int, cutoff: int) -> float | None:
    """The share of the words of ``size`` that occur over ``cutoff`` times; None without words."""
    s = symbols(text)
    n = len(s) - size + 1
    if n < 1:
        return None
    kinds, code = np.unique(s, return_inverse=True)
    bits = max(1, int(len(kinds) - 1).bit_length())
    if bits * size <= 64:  # words as numbers, two bits a symbol for four symbols
        word = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            word = (word << np.uint64(bits)) | code[k : k + n].astype(np.uint64)
    else:
        word = np.lib.stride_tricks.sliding_window_view(s, size).copy().view(f"V{size}").ravel()
    counts = np.unique(word, return_counts=True)[1]
    return float(counts[counts > cutoff].sum() / n)


def word_codes(seq: np.ndarray, size: int) -> np.ndarray:
    """All words of ``size`` (at most 8) symbols in order, a byte a symbol."""
    n = max(len(seq) - size + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | seq[k : k + n]
    return out


def shared_words(words: np.ndarray, row: np.ndarray, rows: int, chunk: int = 1 << 22) -> np.ndarray:
    """(rows, rows): the sum over all words of the smaller of two rows' counts; only rows with a word in common meet, ``chunk`` meetings at a time."""
    word = np.unique(words, return_inverse=True)[1].astype(np.int64)
    key, count = np.unique(word * rows + row, return_counts=True)
    word, row = key // max(rows, 1), key % max(rows, 1)
    start = np.flatnonzero(np.diff(word, prepend=-1))
    size = np.diff(np.append(start, len(word)))
    upto = np.repeat(start + size, size)
    follow = upto - np.arange(len(word)) - 1  # rows with the same word that come later
    out = np.zeros(rows * rows, dtype=np.int64)
    ends = np.cumsum(follow)
    at = 0
    while at < len(word):
        past = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chunk, side="right")))
        n = follow[at:past]
        a = np.repeat(np.arange(at, past), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        if len(a):
            out += np.bincount(row[a] * rows + row[b], weights=np.minimum(count[a], count[b]), minlength=rows * rows).astype(np.int64)
        at = past
    out = out.reshape(rows, rows)
    own = np.bincount(row, weights=count, minlength=rows).astype(np.int64)
    return out + out.T + np.diag(own)


def running(text: str, flank: int) -> list[int]:
    """Positions of the symbols from 1 on, less ``flank``; 0 at gaps and in ``flank`` symbols at each end."""
    here = symbols(text) != GAP
    n = np.cumsum(here)
    inside = here & (n > flank) & (n <= (n[-1] if len(n) else 0) - flank)
    return np.where(inside, n - flank, 0).tolist()


def differing_shares(texts: pa.Array, mixed: pa.Array) -> pa.Array:
    """For each text the largest share of ``1`` in ``mixed`` over a gap-free run; null without one or with a null."""
    out = np.full(len(texts), np.nan)
    rows = [(k, t, m) for k, (t, m) in enumerate(zip(texts.to_pylist(), mixed.to_pylist(), strict=True)) if t and m is not None]
    if rows:
        at, own, marks = zip(*rows, strict=True)
        # All texts in one array, a gap behind each; places in a text's marks follow from where both begin.
        here = symbols("-".join([*own, ""])) != GAP
        edges = np.flatnonzero(np.diff(here, prepend=False, append=False))
        total = np.concatenate(([0], np.cumsum(symbols("".join(marks)) == ord("1"))))
        size = np.array([len(t) for t in own])
        start = np.cumsum(size + 1) - size - 1
        width = np.array([len(m) for m in marks])
        row = np.searchsorted(start, edges[::2], side="right") - 1
        move = (np.cumsum(width) - width - start)[row]
        share = (total[edges[1::2] + move] - total[edges[::2] + move]) / (edges[1::2] - edges[::2])
        first = np.flatnonzero(np.diff(row, prepend=-1))
        if len(first):
            out[np.array(at)[row[first]]] = np.maximum.reduceat(share, first)
    return pa.array(out, pa.float64(), mask=np.isnan(out))


def chosen(text: str, keep: str) -> str:
    """The symbols where ``keep`` is ``1``."""
    return symbols(text)[symbols(keep) == ord("1")].tobytes().decode()


def windows(a: str, b: str, size: int, least: int, rows: int = 1 << 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, n) from 1: windows of ``a`` and ``b`` that agree in ``least`` or more of ``size`` places; ``rows`` windows of ``a`` at a time."""
    x, y = symbols(a), symbols(b)
    n, m = len(x) - size + 1, len(y) - size + 1
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none, none)]
    for at in range(0, max(n, 0) if m > 0 else 0, max(1, min(rows, (1 << 24) // max(m, 1)))):
        part = x[at : at + min(rows, max(1, (1 << 24) // m)) + size - 1]
        k = len(part) - size + 1
        same = part[:, None] == y[None, :]
        agree = np.zeros((k, m), dtype=np.uint8 if size < 256 else np.uint32)
        for s in range(size):
            agree += same[s : s + k, s : s + m]
        i, j = np.nonzero(agree >= least)
        found.append((i + at + 1, j + 1, agree[i, j].astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def of_text(result: str, kind: pa.DataType, fn: Callable) -> Callable[[Column], Column]:
    """A column function that gives ``fn`` of each row's text; null of null."""

    def run(v: pa.Array) -> pa.Array:
        return pa.array([None if x is None else fn(x) for x in v.to_pylist()], kind)

    return F.arrow_udf(run, result)


def of_texts(result: str, kind: pa.DataType, fn: Callable) -> Callable[[Column, Column], Column]:
    """A column function of two texts a row; null where one is null."""

    def run(v: pa.Array, w: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else fn(x, y) for x, y in zip(v.to_pylist(), w.to_pylist(), strict=True)], kind)

    return F.arrow_udf(run, result)
