"""Exact, memoised use of a tokenizers file.

Between two visible characters, a pre-token ends before a single space or line feed, and
between a plain letter and one stop or comma at a word's end.  So a text is encoded piece by piece,
each distinct piece once; a text where this does not hold is encoded whole.  Which letters are
plain is asked of the tokenizer itself, once for each character that comes up: some letters
change into a letter and a mark, which would hold on to a stop.
"""

from __future__ import annotations

import functools
import gc
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Invisible characters that some definitions of white space hold, besides str.isspace().
ODD = "\u180e\u200b\u2060\ufeff"


STOPS = ".,;:!?"


def _visible(c: str) -> bool:
    return not c.isspace() and c not in ODD and c.isprintable()


def _fit(w: str) -> bool:
    """Whether a piece, which may begin with one line feed, has visible characters at both ends."""
    rest = w[1:] if w[:1] == "\n" else w
    return bool(rest) and _visible(rest[0]) and _visible(rest[-1])


def _numbered(code: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers below ``most``, and each number's place among them."""
    found = np.bincount(code, minlength=most) > 0
    return np.flatnonzero(found), (np.cumsum(found) - 1)[code]


class Encoder:
    """ids of texts as bytes of ``dtype``; beyond ``limit`` pieces, only those of the text at hand stay."""

    def __init__(self, path: str, limit: int = 500_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.limit = limit
        self.known: dict[str, bytes | None] = {}
        self.stops = dict(zip(STOPS, self._ids(list(STOPS)), strict=True))
        # Where one word of letters ends in the ids of many: each has one token that begins with
        # the mark of a space, or one that ends with the mark of a word's end.
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.starts = np.array([x.startswith("\u0120") for x in names])
        self.ends = np.array([x.endswith("</w>") for x in names])
        self.folds = self._ids([" Aa"]) == self._ids([" aA"])
        self.heads: dict[str, bytes] = {}  # first pieces, which have no space before them
        self.plain: set[str] = set()
        self.met: set[str] = set()

    def _meet(self, chars: set[str]) -> None:
        """Find out which of some new characters are letters that end before a stop, alone and after other letters."""
        self.met |= chars
        order = [c for c in chars if c.isalpha()]
        asked = [f" {form}{stop}" for c in order for form in (c, f"e{c}", f"{c}e") for stop in ["", *STOPS]]
        found = self._ids(asked)
        width = 3 * (len(STOPS) + 1)
        for at, c in enumerate(order):
            own = found[at * width : (at + 1) * width]
            bare = own[:: len(STOPS) + 1]
            whole = [x for b in bare for x in (b, *(b + self.stops[s] for s in STOPS))]
            if own == whole and all(self._words_in(b) == 1 for b in bare):
                self.plain.add(c)

    def _words_in(self, data: bytes) -> int:
        ids = np.frombuffer(data, dtype=self.dtype)
        return int((self.ends if self.ends.any() else self.starts)[ids].sum())

    def _ids(self, texts: list[str]) -> list[bytes]:
        code = self.code
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], run: int = 64) -> list[bytes]:
        """ids of words of letters, each after a space; many are encoded at once."""
        groups = [words[i : i + run] for i in range(0, len(words), run)]
        out: list[bytes] = []
        for own, data in zip(groups, self._ids([" " + " ".join(g) for g in groups]), strict=True):
            ids = np.frombuffer(data, dtype=self.dtype)
            cuts = np.flatnonzero(self.starts[ids]) if not self.ends.any() else np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(own):
                out += self._ids([f" {w}" for w in own])
                continue
            cuts = (cuts * self.dtype.itemsize).tolist()
            cuts = [*cuts, len(data)] if not self.ends.any() else [0, *cuts]
            out += [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def _learn(self, new: set[str]) -> None:
        known, stops, words, others, ended, folded = self.known, self.stops, set(), [], [], []
        wide = [w for w in new if not w.isascii()]
        self._meet(set("".join(wide)) - self.met)
        plain = self.plain.issuperset
        for w in new.difference(wide):
            if w.isalpha():
                words.add(w)
            elif w[-1:] in stops and w[:-1].isalpha():
                ended.append(w)
                words.add(w[:-1])
            elif _fit(w):
                others.append(w)
            else:
                known[w] = None
        for w in wide:
            if plain(w):
                words.add(w)
            elif w[-1] in stops and plain(w[:-1]) and len(w) > 1:
                ended.append(w)
                words.add(w[:-1])
            elif _fit(w):
                others.append(w)
            else:
                known[w] = None
        words = {w for w in words if w not in known}
        if self.folds:
            folded = [w for w in words if not w.islower() and w.isascii()]
            words.difference_update(folded)
            words.update(x for w in folded if (x := w.lower()) not in known)
        order = list(words)
        known.update(zip(order, self._words(order), strict=True))
        known.update((w, known[w.lower()]) for w in folded)
        known.update(zip(others, self._ids([w if w[0] == "\n" else f" {w}" for w in others]), strict=True))
        for w in ended:
            known[w] = known[w[:-1]] + self.stops[w[-1]]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        was = gc.isenabled()
        gc.disable()  # the many small objects here hold no cycles
        try:
            return self._encode(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()))
        finally:
            if was:
                gc.enable()

    def _pieces(self, words: list[str]) -> list[bytes | None]:
        """ids of distinct pieces, each after a space; None where the rule does not hold at a piece's ends."""
        if len(self.known) > self.limit:
            self.known = {w: self.known[w] for w in words if w in self.known}
        new = set(words).difference(self.known)
        self._learn(new)
        out = list(map(self.known.__getitem__, words))
        for w in new:
            if len(w) > 40:
                del self.known[w]
        return out

    def _first(self, words: list[str]) -> list[bytes]:
        """ids of distinct first pieces."""
        if len(self.heads) > self.limit // 8:
            self.heads = {}
        new = [w for w in words if w not in self.heads]
        self.heads.update(zip(new, self._ids(new), strict=True))
        out = list(map(self.heads.__getitem__, words))
        for w in new:
            if len(w) > 40:
                del self.heads[w]
        return out

    def _encode(self, texts: pa.Array) -> list[bytes]:
        """Pieces are split off, numbered by what they are and put together again as ids in arrays; Python sees each distinct one."""
        if not len(texts):
            return []
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        at = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        head = np.zeros(len(code), dtype=bool)
        head[at[:-1]] = True
        used, rest = _numbered(code[~head], len(names))
        first, ones = _numbered(code[head], len(names))
        firsts = names.take(pa.array(first)).to_pylist()
        ids = self._pieces(names.take(pa.array(used)).to_pylist())
        lost = np.array([x is None for x in ids], dtype=bool)
        bad = np.zeros(len(code), dtype=bool)
        if len(ids):
            bad[~head] = lost[rest]
        alone = np.diff(at) == 1
        bad[at[:-1]] = ~np.array([_fit(w) for w in firsts], dtype=bool)[ones] & ~alone
        whole = np.logical_or.reduceat(bad, at[:-1])
        place = np.empty(len(code), dtype=np.int64)
        place[~head], place[head] = rest, len(ids) + ones
        joined = pa.array([x or b"" for x in ids] + self._first(firsts), pa.large_binary()).take(pa.array(place))
        ends = np.frombuffer(joined.buffers()[1], dtype=np.int64)[at].tolist()
        data = memoryview(joined.buffers()[2]) if ends[-1] else b""
        out = [bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for i in np.flatnonzero(whole).tolist():  # a piece at whose ends the rule does not hold
            out[i] = self._ids([texts[i].as_py()])[0]
        return out


@functools.cache
def encoder(path: str, limit: int = 500_000) -> Encoder:
    """One encoder for each file and Python worker; ``limit`` pieces take about 200 bytes each."""
    return Encoder(path, limit)


def forget() -> None:
    """Drop the encoders that a worker holds from an earlier stage: they are of no use to the next one."""
    encoder.cache_clear()
