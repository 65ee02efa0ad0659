"""Local search with gapped alignments: nucleotides by shared words, proteins by neighbouring words.

Nucleotide seeds are dealt by word: both sides keep, of each window of words, the one with the least hash, so that two sequences with
an exact match of ``size`` share one.  A target's words are left out where they are found if a mask of fixed size over the queries' words has no bit for them.  A frequent word's targets are dealt to several tasks and its query words are copied to
each, so none is left out.  Seeds of a query and a stretch of a target grow in one task: the stretch has a margin of
twice the longest query, so hits are whole wherever they lie; long queries are best cut into parts first.

Proteins go through blocks of the protein set: the queries are a table of the words that theirs score with, and the words of a block
meet all of them in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.functions.dynamic import pieces, strings, through, through_all, through_scores
from seqloom.functions.sequence import rev_compl
from seqloom.plans.groups import meet, small_or_keyed, sorted_groups, spread
from seqloom.plans.recovery import cut

WORD = 16
#: Target words of one kind that a task joins.
FREQUENT = 20_000
HIT = "q string, s string, strand string, q_beg long, q_end long, s_beg long, s_end long, identity double, length long, score long, q_aln string, s_aln string"
_HIT = pa.schema([(x.split()[0], {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[x.split()[1]]) for x in HIT.split(", ")])
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.full(256, 4, dtype=np.uint8)
for _k, _c in enumerate("ACGT"):
    _BASE[[ord(_c), ord(_c.lower())]] = _k


def base_scores(match: int, mismatch: int) -> np.ndarray:
    """Scores over A, C, G, T and one code for everything else, which matches nothing."""
    out = np.full((5, 5), mismatch, dtype=np.int64)
    out[[0, 1, 2, 3], [0, 1, 2, 3]] = match
    return out


def markers(seq: np.ndarray, size: int, word: int = WORD) -> tuple[np.ndarray, np.ndarray]:
    """(place, word) of the words with the least hash of each window of ``size`` bases; words with other symbols take no part."""
    n = len(seq) - word + 1
    if n < 1 or len(seq) < size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    odd = _over(seq > 3, word, lambda a, b, _: a | b)
    packed = _over((seq & 3).astype(np.uint64), word, lambda a, b, k: (a << np.uint64(2 * k)) | b)
    hashed = (packed + np.uint64(1)) * _MIX
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed >>= np.uint64(1)
    hashed[odd] = np.uint64(1 << 63)
    at = _least(hashed, size - word + 1)
    at = at[~odd[at]]
    return at, packed[at].view(np.int64)


def _over(x: np.ndarray, width: int, joined) -> np.ndarray:
    """What ``joined(a, b, length of b)`` makes of each window of ``width`` places: windows of twice the width come from two of them."""
    out, done, have = None, 0, 1
    while True:
        if width & have:
            out = x if out is None else joined(out[: len(out) - have], x[done:], have)
            done += have
        if done == width:
            return out
        x = joined(x[: len(x) - have], x[have:], have)
        have *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The places of the first least value of each window of ``width``, each once: they ascend with the windows."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        n = len(best) - step
        later = best[step:] < best[:n]
        best, at, have = np.where(later, best[step:], best[:n]), np.where(later, at[step:], at[:n]), have + step
    return at[np.flatnonzero(np.diff(at, prepend=-1))]


#: Bits of the mask of words that queries have; more words let more of the others through, and a join decides.
SLOTS = 1 << 20


def _slot(word):
    """The bit of a word, for an array or a column."""
    if isinstance(word, np.ndarray):
        return (word ^ (word >> 13)) & (SLOTS - 1)
    return word.bitwiseXOR(F.shiftright(word, 13)).bitwiseAND(F.lit(SLOTS - 1).cast("long"))


def _mask(words: DataFrame) -> np.ndarray:
    """Which of ``SLOTS`` bits the words (word) set, as bytes: of fixed size, however many there are."""
    held = words.select(_slot(F.col("word")).alias("slot")).distinct().select(F.shiftright("slot", 6).alias("at"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bit"))
    rows = held.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(SLOTS // 64, dtype=np.int64)
    out[[r["at"] for r in rows]] = [r["bits"] for r in rows]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _marked(seqs: DataFrame, size: int, keys: str, wanted: np.ndarray | None = None) -> DataFrame:
    """(keys, at, word) of sequences (keys, seq); words without a bit in ``wanted`` are left out where they are found."""
    names = [k.split()[0] for k in keys.split(", ")]
    packed = None if wanted is None else np.packbits(wanted)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = None if packed is None else np.unpackbits(packed).astype(bool)
        for batch in batches:
            rows, places, words = [], [], []
            for r, seq in enumerate(batch.column(len(names))):
                at, word = markers(_BASE[codes.symbols(seq.as_py() or "")], size)
                if asked is not None:
                    some = asked[_slot(word)]
                    at, word = at[some], word[some]
                if len(at):
                    rows.append(np.full(len(at), r))
                    places.append(at)
                    words.append(word)
            if rows:
                same = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([*[batch.column(k).take(same) for k in range(len(names))], pa.array(np.concatenate(places)), pa.array(np.concatenate(words))], [*names, "at", "word"])

    return seqs.select(*names, "seq").mapInArrow(kernel, f"{keys}, at long, word long")


def stretches(seqs: DataFrame, stride: int, margin: int) -> DataFrame:
    """(s, block, begin, seq): pieces of ``stride`` with ``margin`` symbols on both sides, ``begin`` symbols after the sequence's begin."""
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.greatest(F.length("seq"), F.lit(1)) - 1) / stride)))
    cut = seqs.select("s", "seq", block.alias("block")).withColumn("begin", F.greatest(F.col("block") * stride - margin, F.lit(0)))
    return cut.select("s", "block", "begin", F.substr("seq", (F.col("begin") + 1).cast("int"), ((F.col("block") + 1) * stride + margin - F.col("begin")).cast("int")).alias("seq"))


#: Seeds of a pair that are grown together, at most: a seed that lies in an earlier alignment is left out, so their number doubles from one on.
TOGETHER = 256


def grown(q: str, s: str, seeds: list[tuple[int, int]] | np.ndarray, size: int, scores: np.ndarray, opening: int, extension: int, drop: int) -> list[tuple]:
    """(score, begin in q, begin in s, path) of the alignments through exact matches of ``size`` or more at the seeds, the longest matches first."""
    if not len(seeds):
        return []
    a, b = _BASE[codes.symbols(q)], _BASE[codes.symbols(s)]
    places = np.asarray(seeds, dtype=np.int64).reshape(-1, 2)
    line = places[:, 0] - places[:, 1]
    order = np.argsort(line, kind="stable")
    line, at = line[order], places[order, 0]
    edges = np.flatnonzero(np.diff(line, prepend=line[0] - 1, append=line[-1] + 1))
    runs = set()
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        d = int(line[lo])
        x, y = max(d, 0), max(-d, 0)
        n = min(len(a) - x, len(b) - y)
        off = np.flatnonzero((a[x : x + n] != b[y : y + n]) | (a[x : x + n] > 3)) + x
        ends = np.concatenate(([x - 1], off, [x + n]))
        k = np.searchsorted(ends[1:], at[lo:hi])
        first, past = ends[k] + 1, ends[k + 1]
        long = past - first >= size
        runs.update((f - p, f, f - d) for f, p in zip(first[long].tolist(), past[long].tolist(), strict=True))
    out, seen = [], set()
    waiting = iter(sorted(runs))
    together = 1
    while part := list(islice(((x, y, -n) for n, x, y in waiting if (x, y) not in seen), together)):
        for (x, y, _), (score, i, j, path) in zip(part, through_all(a, b, part, scores, opening, extension, drop), strict=True):
            if (x, y) in seen:
                continue
            out.append((score, i, j, path))
            for step, n in pieces(path):
                if step == "M":
                    seen.update(zip(range(i, i + n), range(j, j + n), strict=True))
                i += n if step != "B" else 0
                j += n if step != "A" else 0
        together = min(2 * together, TOGETHER)
    return out


_FLIP = str.maketrans("ACGTacgtRYKMBVDHryKmbvdh", "TGCAtgcaYRMKVBHDyrMkvbhd")


def _row(name_q, name_s, strand: str, q: str, s: str, begin: int, hit: tuple) -> tuple:
    """One hit as a row: places from 1, along the query; s_beg > s_end on the other strand."""
    score, i, j, path = hit
    n, m = len(path) - path.count("B"), len(path) - path.count("A")
    x, y = strings(q[i : i + n], s[j : j + m], path)
    same = sum(c == d for c, d in zip(x.upper(), y.upper(), strict=True))
    if strand == "+":
        q_beg, s_beg, s_end = i + 1, begin + j + 1, begin + j + m
    else:
        x, y = x.translate(_FLIP)[::-1], y.translate(_FLIP)[::-1]
        q_beg, s_beg, s_end = len(q) - i - n + 1, begin + j + m, begin + j + 1
    return (name_q, name_s, strand, q_beg, q_beg + n - 1, s_beg, s_end, 100.0 * same / len(path), len(path), score, x, y)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _HIT.types, strict=True)], schema=_HIT)


def _once(hits: DataFrame, identity: float, least: int, most: int | None) -> DataFrame:
    """One row a place, and the ``most`` best of each pair."""
    place = ["q", "s", "strand", "q_beg", "q_end", "s_beg", "s_end", "score"]
    found = hits.where((F.col("identity") >= identity) & (F.col("score") >= least))
    found = found.groupBy(*place).agg(F.min(F.struct("q_aln", "s_aln", "identity", "length")).alias("x")).select(*place, "x.*").select(*_HIT.names)
    if most is None:
        return found
    rank = F.row_number().over(Window.partitionBy("q", "s").orderBy(F.desc("score"), "q_beg", "s_beg", "q_end", "s_end", "strand"))
    return found.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank")


def local_hits(
    queries: DataFrame, targets: DataFrame, size: int = 28, identity: float = 0.0, least: int = 0, most: int | None = None, match: int = 1, mismatch: int = -2, opening: int = 10, extension: int = 2, drop: int = 30, stride: int = 1 << 15,
) -> DataFrame:
    """Gapped local alignments of (name, seq) tables on both strands: (q, s, strand, q_beg, q_end, s_beg, s_end, identity, length, score, q_aln, s_aln).

    A hit has an exact match of ``size`` bases or more.  Names are texts and tell sequences apart; null and short
    sequences have no hits, and a sequence meets itself if it is on both sides (``hits.without_self`` removes that).
    """
    names = lambda df, n: df.select(F.col("name").cast("string").alias(n), F.col("seq").cast("string").alias("seq"))
    # Null targets mark no words; to ask for them here would make their texts once more.
    q, s = names(queries, "q").where("seq IS NOT NULL"), names(targets, "s")
    longest = int(q.agg(F.coalesce(F.max(F.length("seq")), F.lit(0))).first()[0])
    q = q.select("q", F.lit("+").alias("strand"), "seq").unionByName(q.select("q", F.lit("-").alias("strand"), rev_compl(F.col("seq")).alias("seq")))
    blocks = stretches(s, stride, 2 * longest + drop)
    # Each stretch is searched whole; a place in a margin is the neighbour's.
    word_q = cut(_marked(q, size, "q string, strand string").withColumnRenamed("at", "x"))
    inner = (F.col("begin") + F.col("at")).alias("y")
    word_s = _marked(blocks.withColumn("block", F.struct("block", "begin")).select("s", "block", "seq"), size, "s string, block struct<block:long,begin:long>", _mask(word_q)).select("s", "block.*", "at", "word")
    word_s = cut(word_s.select("s", "block", inner, "word").where(F.floor(F.col("y") / stride) == F.col("block")))
    seeds = cut(meet(word_q, word_s, "word", FREQUENT).groupBy("q", "strand", "s", "block").agg(F.collect_list(F.struct("x", "y")).alias("seeds")))
    # Only targets with seeds are read again, and only their stretches with seeds move.
    blocks = stretches(s.join(small_or_keyed(seeds.select("s").distinct()), "s", "left_semi"), stride, 2 * longest + drop)
    blocks = blocks.join(small_or_keyed(seeds.select("s", "block").distinct()), ["s", "block"], "left_semi")
    pairs = seeds.join(small_or_keyed(q.withColumnRenamed("seq", "q_seq"), 10_000), ["q", "strand"]).join(blocks, ["s", "block"]).select("q", "s", "strand", "q_seq", "seq", "begin", "seeds")
    scores = base_scores(match, mismatch)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name_q, name_s, strand, a, b, begin, at in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found = grown(a, b, [(p["x"], p["y"] - begin) for p in at], size, scores, opening, extension, drop)
                out += [_row(name_q, name_s, strand, a, b, begin, h) for h in found]
            if out:
                yield _batch(out)

    return _once(pairs.mapInArrow(kernel, HIT), identity, least, most)


def two_sequences(pairs: DataFrame, size: int = 28, match: int = 1, mismatch: int = -2, opening: int = 10, extension: int = 2, drop: int = 30) -> DataFrame:
    """Hits of s1 in s2 of each pair (id, s1, s2), from both directions, each once: (id, strand, beg1, end1, beg2, end2, identity, length, score, aln1, aln2).

    Places in s1 ascend; on the other strand beg2 > end2.  A direction may cut a tie otherwise, so both are asked.  Pairs are dealt to all tasks
    by their id: a file of few parts would leave most of them idle.
    """
    kind = pairs.schema["id"].dataType.simpleString()
    scores = base_scores(match, mismatch)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for r, (s1, s2) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if s1 is None or s2 is None:
                    continue
                # Words are marked once for each sequence and strand.
                marked = {(k, strand): (t, markers(_BASE[codes.symbols(t)], size)) for k, s in enumerate((s1, s2)) for strand, t in (("+", s), ("-", s.translate(_FLIP)[::-1]))}
                for first in (True, False):
                    b, (y, v) = marked[int(first), "+"]
                    for strand in "+-":
                        own, (x, u) = marked[int(not first), strand]
                        order = np.argsort(v, kind="stable")
                        lo, hi = np.searchsorted(v[order], u), np.searchsorted(v[order], u, side="right")
                        seeds = np.stack((np.repeat(x, hi - lo), y[order[np.repeat(lo, hi - lo) + _within(hi - lo)]]), axis=1)
                        for hit in grown(own, b, seeds, size, scores, opening, extension, drop):
                            row = _row("", "", strand, own, b, 0, hit)
                            if not first:
                                _, _, _, q_beg, q_end, s_beg, s_end, same, n, score, x_aln, y_aln = row
                                if strand == "-":
                                    row = ("", "", strand, s_end, s_beg, q_end, q_beg, same, n, score, y_aln.translate(_FLIP)[::-1], x_aln.translate(_FLIP)[::-1])
                                else:
                                    row = ("", "", strand, s_beg, s_end, q_beg, q_end, same, n, score, y_aln, x_aln)
                            ids.append(r)
                            out.append(row)
            if out:
                made = _batch(out)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids)), *[made.column(k) for k in range(2, 12)]], [n.split()[0] for n in _PAIR.split(", ")])

    found = spread(pairs.select("id", "s1", "s2"), "id").mapInArrow(kernel, _PAIR.replace("KIND", kind))
    place = ["id", "strand", "beg1", "end1", "beg2", "end2", "score"]
    return found.groupBy(*place).agg(F.min(F.struct("aln1", "aln2", "identity", "length")).alias("x")).select(*place, "x.*")


_PAIR = "id KIND, strand string, beg1 long, end1 long, beg2 long, end2 long, identity double, length long, score long, aln1 string, aln2 string"

# --- proteins -------------------------------------------------------------------------------------
# The BLOSUM62 scores of the standard residues with those up to themselves, in the order of RESIDUES.
RESIDUES = "ARNDCQEGHILKMFPSTWYVX*"
BLOSUM62 = """
 4
-1  5
-2  0  6
-2 -2  1  6
 0 -3 -3 -3  9
-1  1  0  0 -3  5
-1  0  0  2 -4  2  5
 0 -2  0 -1 -3 -2 -2  6
-2  0  1 -1 -3  0  0 -2  8
-1 -3 -3 -3 -1 -3 -3 -4 -3  4
-1 -2 -3 -4 -1 -2 -3 -4 -3  2  4
-1  2  0 -1 -3  1  1 -2 -1 -3 -2  5
-1 -1 -2 -3 -1  0 -2 -3 -2  1  2 -1  5
-2 -3 -3 -3 -2 -3 -3 -3 -1  0  0 -3  0  6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4  7
 1 -1  1  0 -1  0  0  0 -1 -2 -2  0 -1 -2 -1  4
 0 -1  0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1  1  5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1  1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3  2 -1 -1 -2 -1  3 -3 -2 -2  2  7
 0 -3 -3 -3 -1 -2 -2 -3 -3  3  1 -2  1 -1 -2 -2  0 -3 -1  4
"""


def _amino_scores() -> np.ndarray:
    """The table in both directions; X, which stands for every other symbol, scores -1 with all, and a stop -4, or 1 with a stop."""
    out = np.full((22, 22), -1, dtype=np.int64)
    for k, line in enumerate(BLOSUM62.strip().split("\n")):
        out[k, : k + 1] = out[: k + 1, k] = [int(x) for x in line.split()]
    out[21, :], out[:, 21], out[21, 21] = -4, -4, 1
    return out


AMINO_SCORES = _amino_scores()
_RESIDUE = np.full(256, RESIDUES.index("X"), dtype=np.uint8)
for _k, _c in enumerate(RESIDUES):
    _RESIDUE[[ord(_c), ord(_c.lower())]] = _k
_LETTERS = 20  # words have standard residues alone


@lru_cache(maxsize=2)
def neighbours(threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, word): the words of three residues that score ``threshold`` or more with each word, one after another."""
    one = AMINO_SCORES[:_LETTERS, :_LETTERS]
    begin, found = [0], []
    for a in range(_LETTERS):
        for b in range(_LETTERS):
            for c in range(_LETTERS):
                total = one[a][:, None, None] + one[b][None, :, None] + one[c][None, None, :]
                found.append(np.flatnonzero(total.ravel() >= threshold))
                begin.append(begin[-1] + len(found[-1]))
    return np.array(begin), np.concatenate(found)


def _words(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, word) of the words of three standard residues."""
    n = max(len(seq) - 2, 0)
    ok = (seq[:n] < _LETTERS) & (seq[1 : n + 1] < _LETTERS) & (seq[2 : n + 2] < _LETTERS)
    at = np.flatnonzero(ok)
    s = seq.astype(np.int64)
    return at, (s[at] * _LETTERS + s[at + 1]) * _LETTERS + s[at + 2]


#: Scores with one more code, which ends every stretch.
_FAR = -(1 << 20)
_ENDED = np.pad(AMINO_SCORES, (0, 1), constant_values=_FAR).astype(np.int32)


def ungapped(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, drop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, first, past) along ``a``: for each word at (x, y) the best stretch of its diagonal, each side given up ``drop`` below its best.

    All stretches grow together, a place at a time; ``a`` and ``b`` begin and end with the code that ends a stretch.
    """
    score = sum(_ENDED[a[x + k], b[y + k]] for k in range(3)).astype(np.int64)
    ends = []
    for step, begin in ((-1, 0), (1, 2)):
        live = np.arange(len(x))
        total, best, reach = np.zeros(len(x), dtype=np.int32), np.zeros(len(x), dtype=np.int32), np.zeros(len(x), dtype=np.int64)
        k = 0
        while len(live):
            k += 1
            at = begin + k * step
            total[live] += _ENDED[a[x[live] + at], b[y[live] + at]]
            more = live[total[live] > best[live]]
            best[more], reach[more] = total[more], k
            live = live[total[live] >= best[live] - drop]
        score += best
        ends.append(reach)
    return score, x - ends[0], x + 3 + ends[1]


#: Meetings of words that are sorted at once.
MEETINGS = 1 << 19


def _joined(parts: list[np.ndarray], room: int) -> tuple[np.ndarray, np.ndarray]:
    """All parts in one array with ``room`` symbols that end a stretch before, between and after them, and where each begins."""
    end = np.full(room, len(RESIDUES), dtype=np.uint8)
    start = np.cumsum([room, *[len(c) + room for c in parts]])
    return np.concatenate([end, *[x for c in parts for x in (c, end)]]), start


class QueryTable:
    """Queries by the words that theirs score ``threshold`` or more with."""

    def __init__(self, names: list[str], seqs: list[str], threshold: int = 11, window: int = 40) -> None:
        self.names, self.seqs, self.window = names, seqs, window
        self.codes = [_RESIDUE[codes.symbols(s)] for s in seqs]
        self.joined, self.start = _joined(self.codes, window + 1)
        at, word = _words(self.joined)
        begin, near = neighbours(threshold)
        n = begin[word + 1] - begin[word]
        place, word = np.repeat(at, n), near[np.repeat(begin[word], n) + _within(n)]
        self.place = place[np.argsort(word, kind="stable")]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=_LETTERS**3))))
        # A meeting is told by its diagonal and its place, and no diagonal is near the next one.
        self.span = len(self.joined) + window + 1
        self.keys = self.place * (1 - self.span) + len(self.joined) * self.span


class ProteinBlock:
    """Part of a protein set, which all queries of a table are looked up in at once."""

    def __init__(self, names: list[str], seqs: list[str], threshold: int = 11, window: int = 40) -> None:
        self.names, self.seqs, self.threshold, self.window = names, seqs, threshold, window
        self.codes = [_RESIDUE[codes.symbols(s)] for s in seqs]
        self.joined, self.start = _joined(self.codes, window + 1)

    def meetings(self, queries: QueryTable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in the joined queries, place in the joined proteins) of words that follow another one, apart, within ``window`` places of one diagonal.

        Whole proteins are taken together, of some ``MEETINGS`` meetings of words.
        """
        at, word = _words(self.joined)
        n = queries.first[word + 1] - queries.first[word]
        # Where the words of a protein begin, and how many meetings come before.
        edge = np.searchsorted(at, self.start)
        total = np.concatenate(([0], np.cumsum(n)))[edge]
        lo = 0
        while lo < len(self.codes):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + MEETINGS, side="right")) - 1)
            own = slice(edge[lo], edge[hi])
            m = n[own]
            key = np.repeat(queries.first[word[own]] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            key = queries.keys[key] + np.repeat(at[own] * queries.span, m)
            key.sort()
            two = np.zeros(len(key), dtype=bool)
            for k in (1, 2, 3):  # the nearest word that is 3 or more before is one of three
                apart = key[k:] - key[:-k]
                two[k:] |= (apart >= 3) & (apart <= self.window)
            key = key[two]
            x = key % queries.span
            yield x, key // queries.span - len(queries.joined) + x
            lo = hi

    def seeds(self, query: np.ndarray) -> np.ndarray:
        """(protein, x, y) of ``meetings`` with one query, given by its codes."""
        table = QueryTable([""], ["".join(RESIDUES[c] for c in query)], self.threshold, self.window)
        x, y = (np.concatenate([np.zeros(0, dtype=np.int64), *c]) for c in zip(*self.meetings(table), strict=True))
        which = np.searchsorted(self.start, y, side="right") - 1
        return np.stack((which, x - table.start[0], y - self.start[which]), axis=1)

    def hits(self, queries: QueryTable, cutoff: int, least: int, opening: int, extension: int, drop: int, ungapped_drop: int) -> Iterator[tuple]:
        for x, y in self.meetings(queries):
            score, first, past = ungapped(queries.joined, self.joined, x, y, ungapped_drop)
            keep = score >= cutoff
            found = np.unique(np.stack((y - x, first, past, score), axis=1)[keep], axis=0)
            strong: dict[tuple[int, int], set[tuple[int, int, int]]] = {}
            which = np.stack((np.searchsorted(queries.start, found[:, 1], side="right") - 1, np.searchsorted(self.start, found[:, 0] + found[:, 1], side="right") - 1), axis=1)
            for (q, p), (line, begin, until, total) in zip(which.tolist(), found.tolist(), strict=True):
                # Gapped growth starts at the best word of the stretch.
                pairs = AMINO_SCORES[queries.joined[begin:until], self.joined[begin + line : until + line]]
                k = begin + int(np.argmax(pairs[:-2] + pairs[1:-1] + pairs[2:]))
                strong.setdefault((q, p), set()).add((-total, k - int(queries.start[q]), k + line - int(self.start[p])))
            every = [(queries.codes[q], self.codes[p], x, y) for (q, p), starts in strong.items() for _, x, y in starts]
            grown = iter(through_scores(every, 3, AMINO_SCORES, opening, extension, drop))
            for (q, p), starts in strong.items():
                # Paths are made only for a pair of which some alignment is good enough.
                if max([next(grown) for _ in starts]) < least:
                    continue
                seen: set[tuple[int, int]] = set()
                for _, x, y in sorted(starts):
                    if (x, y) in seen:
                        continue
                    hit = through(queries.codes[q], self.codes[p], x, y, 3, AMINO_SCORES, opening, extension, drop)
                    _, i, j, path = hit
                    for step in path:
                        if step == "M":
                            seen.add((i, j))
                        i += step != "B"
                        j += step != "A"
                    if hit[0] >= least:
                        yield _row(queries.names[q], self.names[p], "+", queries.seqs[q], self.seqs[p], 0, hit)


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, .. n - 1 for each n."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _tables(names: list[str], seqs: list[str], threshold: int, window: int, residues: int = 1 << 14) -> list[QueryTable]:
    """The queries as tables of about ``residues`` each: what a long protein meets at once grows with them."""
    part = np.cumsum([0, *[len(s) for s in seqs]])[:-1] // residues
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    return [QueryTable(names[lo:hi], seqs[lo:hi], threshold, window) for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def protein_hits(
    queries: DataFrame, proteins: DataFrame, threshold: int = 11, window: int = 40, cutoff: int = 41, least: int = 40, opening: int = 11, extension: int = 1, drop: int = 38, ungapped_drop: int = 16, most: int | None = None, residues: int = 1 << 17,
) -> DataFrame:
    """Gapped local alignments of amino-acid sequences (name, seq), columns as in ``local_hits``; strand is +.

    Two words of one diagonal within ``window`` places start a stretch without gaps, and one that scores ``cutoff`` or more starts an
    alignment; ``least`` is what that must score.  Symbols that are no residues count as X; null sequences have no hits.
    The protein set is dealt to blocks of about ``residues``.
    """
    q = queries.select(F.col("name").cast("string").alias("name"), F.col("seq").cast("string").alias("seq")).where("seq IS NOT NULL")
    p = proteins.select(F.col("name").cast("string").alias("name"), F.col("seq").cast("string").alias("seq")).where("seq IS NOT NULL")
    parts = max(1, -(-int(p.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0))).first()[0]) // residues))
    block = F.pmod(F.xxhash64("name", "seq"), F.lit(parts)).cast("int").alias("block")
    # A task makes the table of its queries once; many are dealt to several tasks, each with the block.
    lots = max(1, -(-q.count() // 5000))
    lot = F.pmod(F.xxhash64("name", "seq"), F.lit(lots)).cast("int").alias("lot")
    a = p.select(block, F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"), F.lit(0).alias("side"), "name", "seq")
    b = q.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("block"), lot, F.lit(1).alias("side"), "name", "seq")
    dealt = spread(a.unionByName(b), "block", "lot").sortWithinPartitions("block", "lot", "side", "name", "seq")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[list, list, list[QueryTable]] = ([], [], [])
        for group in sorted_groups(batches, 2):
            side = group.column(2).to_numpy()
            names, seqs = group.column(3).to_pylist(), group.column(4).to_pylist()
            n = int((side == 0).sum())
            if not n:
                continue
            if known[:2] != (names[n:], seqs[n:]):
                known = names[n:], seqs[n:], _tables(names[n:], seqs[n:], threshold, window)
            block = ProteinBlock(names[:n], seqs[:n], threshold, window)
            for table in known[2]:
                if found := list(block.hits(table, cutoff, least, opening, extension, drop, ungapped_drop)):
                    yield _batch(found)

    return _once(dealt.mapInArrow(kernel, HIT), 0.0, least, most)
