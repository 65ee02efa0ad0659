"""Removal of repeated passages: every byte that a ``WIDTH``-byte string covers which also starts earlier.

Suffix arrays are built in shards, and equal strings must meet in one.  So each string of
``WIDTH`` bytes is led by its anchor, the leftmost ``SEED``-byte part with the least hash,
which depends on the string alone.  Consecutive strings with one anchor form a context.

1. Map: contexts of each document become records (anchor, hash of the context, place).  Of equal
   contexts in a batch only the first is sent; the others are repeated whatever stands elsewhere.
   A context that comes twice in a batch is remembered for the rest of the task, so what all documents
   hold makes a record a task, not one a batch.
2. Records meet by anchor.  Equal contexts (64 bits of hash for the anchor and 64 for the whole) are
   aggregated to the first of them, which goes on only if its anchor has another context too.
3. The bytes of what is left are fetched from their documents and meet by anchor in shards, each
   ordered by induced sorting; permuted common prefixes of ``WIDTH`` bytes or more show the
   repeats.  An anchor with over ``HOT`` contexts is cut into parts by how far a string reaches to
   either side of it, and meets by what such strings have in common.  Many documents may share a line of under
   ``WIDTH`` bytes, and so all of these parts without a repeat.  An anchor with over ``CROWD`` contexts
   is cut into its strings, which meet by 128 bits of hash, without their bytes: then only equal strings
   meet, and of these each bucket of documents sends the first.
4. Repeated ranges and texts meet by document, and the bytes are removed.

In step 2 the records of one anchor (some 30 bytes for each different context) are in one task; nothing else grows with
the number of documents that share a line.

Documents move as compressed blobs of many documents; documents of any length are read in
pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import give_back, packed, sliced, sorted_groups, text_of
from seqloom.llm.sharding import mix
from seqloom.llm.suffixes import repeated
from seqloom.llm.tokens import forget
from seqloom.plans.recovery import table

WIDTH, SEED, HOT, CROWD = 100, 32, 512, 1 << 14
REACH = WIDTH - SEED  # a string begins up to this many bytes before its anchor
PIECE, SHARD = 2 << 20, 2 << 20  # bytes that a task scans or orders at a time
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)
RECORD = np.dtype([("low", "<u4"), ("high", "<u2"), ("context", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("more", "u1")])
RANGE = np.dtype([("uid", "<i8"), ("start", "<u4"), ("more", "<u4")])
CHECK = np.dtype([("uid", "<i8"), ("start", "<u4"), ("more", "u1"), ("hot", "u1"), ("anchor", "<u8")])
CHECKED = 8  # bytes of a string's second hash
ROW = "bucket int, kind int, target int, data binary"
DUP, ASK, TEXT, RECS = 0, 1, 2, 3


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:3]), pa.array(cols[3], pa.binary())], ["bucket", "kind", "target", "data"])


def _dealt(values: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``values`` by bucket number, in order within each."""
    if not len(values):
        return
    order = np.argsort(bucket, kind="stable")
    values, bucket = values[order], bucket[order]
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(bucket)], strict=True):
        yield int(bucket[lo]), values[lo:hi]


def home(uids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(uids) % np.uint64(buckets)).astype(np.int32)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the seed at each position, position of the anchor of the string at each position)."""
    n = len(data)
    words = np.ndarray((n,), "<u8", data + b"\0" * 8, 0, (1,)) * MULTIPLIERS[4]
    words ^= words >> np.uint64(32)
    m = n - SEED + 1
    h = words[:m] * MULTIPLIERS[0]
    for j in range(1, SEED // 8):
        h += words[8 * j : 8 * j + m] * MULTIPLIERS[j]
    h ^= h >> np.uint64(29)
    h *= MULTIPLIERS[4]
    h ^= h >> np.uint64(32)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    size = 1
    while 2 * size <= REACH + 1:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < REACH + 1:
        rest = REACH + 1 - size
        key = np.minimum(key[:-rest], key[rest:])
    return h, (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def contexts(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, piece, start, more) of every context: strings start at start .. start + more."""
    data = b"".join(pieces)
    if len(data) < WIDTH:
        return tuple(np.zeros(0, t) for t in ("<u8", "<u8", "<i8", "<i8", "<i8"))
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    ends = np.cumsum(sizes)
    hashes, lead = anchors(data)
    valid = (np.repeat(ends, sizes) - np.arange(len(data)))[: len(lead)] >= WIDTH
    at = np.flatnonzero(np.concatenate(([True], (lead[1:] != lead[:-1]) | (valid[1:] != valid[:-1]))))
    more = np.diff(np.append(at, len(lead))) - 1
    at, more = at[valid[at]], more[valid[at]]
    digest = xxhash.xxh3_64_intdigest
    held = np.array([digest(data[a:b]) for a, b in zip(at.tolist(), (at + more + WIDTH).tolist(), strict=True)], dtype=np.uint64)
    piece = np.searchsorted(ends, at, side="right")
    return hashes[lead[at]], held, piece, at - (ends - sizes)[piece], more


def _cut(uids: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(uid, base, bytes) of pieces of at most PIECE starts; neighbours share WIDTH - 1 bytes."""
    who, base, out = [], [], []
    for uid, t in zip(uids.tolist(), texts, strict=True):
        for at in range(0, max(1, len(t) - WIDTH + 1), PIECE):
            who.append(uid)
            base.append(at)
            out.append(t[at : at + PIECE + WIDTH - 1])
    return np.array(who, dtype=np.int64), np.array(base, dtype=np.int64), out


def _ranges(uid: np.ndarray, start: np.ndarray, more: np.ndarray) -> np.ndarray:
    out = np.empty(len(uid), dtype=RANGE)
    out["uid"], out["start"], out["more"] = uid, start, more
    return out


def _uids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


class Frequent:
    """Contexts that a task has met twice, with the first place of each: a task sends them once, not once a batch.

    Beyond ``most`` contexts, new ones are sent with every batch; results do not change.
    """

    def __init__(self, most: int = 1 << 16) -> None:
        self.most, self.places, self.held = most, {}, np.zeros(0, np.uint64)

    def meet(self, anchor: np.ndarray, held: np.ndarray, uid: np.ndarray, start: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Which contexts have an earlier place here; an earlier one of theirs replaces that."""
        out = np.zeros(len(held), dtype=bool)
        for i in np.flatnonzero(among & np.isin(held, self.held)).tolist():
            key, place = (int(anchor[i]), int(held[i])), (int(uid[i]), int(start[i]))
            old = self.places.get(key)
            if old is not None and old < place:
                out[i] = True
            elif old is not None:
                self.places[key] = place
        return out

    def add(self, anchor: np.ndarray, held: np.ndarray, uid: np.ndarray, start: np.ndarray) -> None:
        for key, place in zip(zip(anchor.tolist(), held.tolist(), strict=True), zip(uid.tolist(), start.tolist(), strict=True), strict=True):
            if len(self.places) < self.most:
                self.places.setdefault(key, place)
        self.held = np.array([k[1] for k in self.places], dtype=np.uint64)


def _scan(buckets: int):
    """Step 1: (uid, text) to records by anchor, and ranges that repeat in their task."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        frequent = Frequent()
        for batch in sliced(batches, 1, PIECE):
            who, base, pieces = _cut(_uids(batch), [text_of(t) for t in batch.column(1).to_pylist()])
            ends = np.cumsum([len(p) for p in pieces])
            at = np.flatnonzero(np.diff(ends // PIECE, prepend=-1))
            for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(pieces)], strict=True):
                anchor, held, piece, start, more = contexts(pieces[lo:hi])
                uid, start = who[lo + piece], start + base[lo + piece]
                order = np.lexsort((start, uid, held, anchor))
                anchor, held, piece, uid, start, more = (x[order] for x in (anchor, held, piece, uid, start, more))
                again = np.zeros(len(order), dtype=bool)
                again[1:] = (anchor[1:] == anchor[:-1]) & (held[1:] == held[:-1])
                twice = np.flatnonzero(~again & np.append(again[1:], False))
                again |= frequent.meet(anchor, held, uid, start, ~again)
                frequent.add(anchor[twice], held[twice], uid[twice], start[twice])
                dup = _ranges(uid[again], start[again], more[again])
                out = [(b % buckets, DUP, b, x.tobytes()) for b, x in _dealt(dup, home(dup["uid"], buckets))]
                first = ~again
                rec = np.empty(int(first.sum()), dtype=RECORD)
                high = anchor[first] // np.uint64(buckets)
                rec["low"], rec["high"] = high & np.uint64(0xFFFFFFFF), (high >> np.uint64(32)) & np.uint64(0xFFFF)
                rec["context"], rec["doc"], rec["start"], rec["more"] = held[first], piece[first], start[first], more[first]
                for b, own in _dealt(rec, (anchor[first] % np.uint64(buckets)).astype(np.int32)):
                    docs, at = np.unique(own["doc"], return_inverse=True)
                    own["doc"] = at
                    out.append((b, RECS, 0, np.int64(len(docs)).tobytes() + who[lo + docs].tobytes() + own.tobytes()))
                if out:
                    yield _rows(out)

    return kernel


def _classes(buckets: int):
    """Step 2: of each class of equal contexts all but the first repeat; firsts of shared anchors are asked for."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches):
            bucket, uids, recs, out = group.column(0)[0].as_py(), [], [], []
            for kind, target, data in zip(group.column(1).to_pylist(), group.column(2).to_pylist(), group.column(3).to_pylist(), strict=True):
                if kind == DUP:
                    out.append((target, DUP, 0, data))
                    continue
                n = int(np.frombuffer(data, "<i8", 1)[0])
                own = np.frombuffer(data, RECORD, offset=8 + 8 * n)
                recs.append(own)
                uids.append(np.frombuffer(data, "<i8", n, 8)[own["doc"]])
            if recs:
                rec, uid = np.concatenate(recs), np.concatenate(uids)
                anchor = rec["low"].astype(np.uint64) | (rec["high"].astype(np.uint64) << np.uint64(32))
                order = np.lexsort((rec["start"], uid, rec["context"], anchor))
                rec, uid, anchor = rec[order], uid[order], anchor[order]
                new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
                first = new.copy()
                first[1:] |= rec["context"][1:] != rec["context"][:-1]
                dup = _ranges(uid[~first], rec["start"][~first], rec["more"][~first])
                out += [(b, DUP, 0, x.tobytes()) for b, x in _dealt(dup, home(dup["uid"], buckets))]
                number = np.cumsum(new) - 1
                classes = np.bincount(number, weights=first)[number]
                ask = first & (classes > 1)
                want = np.empty(int(ask.sum()), dtype=CHECK)
                want["uid"], want["start"], want["more"] = uid[ask], rec["start"][ask], rec["more"][ask]
                want["hot"], want["anchor"] = (classes[ask] > HOT).astype("u1") + (classes[ask] > CROWD), anchor[ask] * np.uint64(buckets) + np.uint64(bucket)
                out += [(b, ASK, 0, x.tobytes()) for b, x in _dealt(want, home(want["uid"], buckets))]
            if out:
                yield _rows(out)

    return kernel


def _blobs(buckets: int):
    """(uid, doc_id, text) to compressed blobs of documents by home bucket."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2):
            for b, at in _dealt(np.arange(batch.num_rows), home(_uids(batch), buckets)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(batch.take(pa.array(at)))
                yield _rows([(b, TEXT, 0, sink.getvalue().to_pybytes())])

    return kernel


def _opened(data: bytes) -> Iterator[tuple[int, int | None, bytes]]:
    for batch in pa.ipc.open_stream(data):
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), map(text_of, batch.column(2).to_pylist()), strict=True)


class Asked:
    """Records by uid."""

    def __init__(self, blobs: list[bytes], dtype: np.dtype) -> None:
        rows = np.concatenate([np.frombuffer(b, dtype) for b in blobs]) if blobs else np.zeros(0, dtype)
        self.rows = rows[np.lexsort((rows["start"], rows["uid"]))]
        self.uids = self.rows["uid"]

    def of(self, uid: int) -> np.ndarray:
        lo, hi = np.searchsorted(self.uids, [uid, uid + 1]) if uid < (1 << 63) - 1 else (np.searchsorted(self.uids, uid), len(self.uids))
        return self.rows[lo:hi]


#: Ranges of how many bytes a string has on its short side of the anchor.
_SIDES = [(0, 0), (1, 2), (3, 6), (7, 14), (15, REACH // 2)]


def parts(text: bytes, start: int, more: int, anchor: int, at: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(key, first start, more, bytes) of the parts of a hot context whose anchor stands at ``at``.

    Strings of a part have at least the part's least reach on both sides of the anchor in common
    if they are equal, so the key may hold those bytes.
    """
    for side in (0, 1):
        for lo, hi in _SIDES:
            if side and (lo, hi) == _SIDES[-1]:
                hi = REACH - REACH // 2 - 1
            least, most = (lo, hi) if side == 0 else (REACH - hi, REACH - lo)
            a, b = max(start, at - most), min(start + more, at - least)
            if a <= b:
                shared = text[at - least : at + SEED + REACH - most]
                yield xxhash.xxh3_64_intdigest(shared, anchor & 0xFFFFFFFFFFFFFFFF) ^ (16 * side + lo), a, b - a, text[a : b + WIDTH]


def strings(text: bytes, start: int, more: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(key, start, 0, check) of each string of a context: two hashes in place of its bytes."""
    for a in range(start, start + more + 1):
        one = text[a : a + WIDTH]
        yield xxhash.xxh3_64_intdigest(one), a, 0, xxhash.xxh64_digest(one)


def _fetch(buckets: int):
    """Step 3a: the bytes of the contexts that are asked for, by key; equal parts in a bucket are sent once."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_bucket(batches):
            asked = Asked(group[ASK], CHECK)
            if not len(asked.rows):
                continue
            seen: dict[tuple, tuple] = {}
            keys, uids, starts, datas, dup = [], [], [], [], []
            for blob in group[TEXT]:
                for uid, _, text in _opened(blob):
                    own = asked.of(uid)
                    for start, more, hot, anchor in zip(own["start"].tolist(), own["more"].tolist(), own["hot"].tolist(), own["anchor"].tolist(), strict=True):
                        if not hot:
                            keys.append(anchor)
                            uids.append(uid)
                            starts.append(start)
                            datas.append(text[start : start + more + WIDTH])
                            continue
                        lead = int(anchors(text[start : start + WIDTH])[1][0]) + start
                        for key, a, n, data in parts(text, start, more, anchor, lead) if hot == 1 else strings(text, start, more):
                            place, old = (uid, a, n), seen.get((key, data))
                            if old is None or place < old:
                                seen[key, data], place = place, old
                            if place is not None:
                                dup.append(place)
            for (key, data), (uid, a, _) in seen.items():
                keys.append(key)
                uids.append(uid)
                starts.append(a)
                datas.append(data)
            for lo in range(0, len(keys), 8192):
                hi = lo + 8192
                yield pa.RecordBatch.from_arrays([pa.array(np.array(keys[lo:hi], np.uint64).view(np.int64)), pa.array(uids[lo:hi], pa.int64()), pa.array(starts[lo:hi], pa.int64()), pa.array(datas[lo:hi], pa.binary())], ["key", "uid", "start", "data"])
            if dup:  # a range without bytes
                yield pa.RecordBatch.from_arrays([pa.array([int(d[0] * 0x9E3779B1 + d[1]) % (1 << 63) for d in dup], pa.int64()), pa.array([d[0] for d in dup], pa.int64()), pa.array([d[1] for d in dup], pa.int64()), pa.array([np.uint32(d[2]).tobytes() for d in dup], pa.binary())], ["key", "uid", "start", "data"])

    return kernel


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of each bucket by kind; texts come last, and one blob of them at a time."""
    rows = ((b, k, d) for batch in batches for b, k, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True))
    for _, own in groupby(rows, key=itemgetter(0)):
        held: dict = {DUP: [], ASK: [], TEXT: iter(())}
        for _, kind, data in own:
            if kind == TEXT:
                held[TEXT] = chain((data.as_py(),), (x.as_py() for _, _, x in own))
                break
            held[kind].append(data.as_py())
        yield held
    held = None
    give_back()


def _shards(buckets: int):
    """Step 3b: contexts sorted by key, in shards of whole keys, to ranges that repeat."""

    def solved(keys: list, uids: list, starts: list, datas: list) -> list[tuple]:
        order = sorted(range(len(uids)), key=lambda i: (uids[i], starts[i]))
        flags = repeated([datas[i] for i in order], WIDTH)
        at = np.flatnonzero(flags)
        if not len(at):
            return []
        ends = np.cumsum([len(datas[i]) + 1 for i in order])
        piece = np.searchsorted(ends, at, side="right")
        off = at - np.concatenate(([0], ends[:-1]))[piece]
        cut = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (piece[1:] != piece[:-1]))))
        more = np.diff(np.append(cut, len(at))) - 1
        uid = np.array([uids[i] for i in order], dtype=np.int64)[piece[cut]]
        start = np.array([starts[i] for i in order], dtype=np.int64)[piece[cut]] + off[cut]
        dup = _ranges(uid, start, more)
        return [(b, DUP, 0, x.tobytes()) for b, x in _dealt(dup, home(dup["uid"], buckets))]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held: list[list] = [[], [], [], []]
        size, plain = 0, []
        for group in sorted_groups(batches):
            cols = [c.to_pylist() for c in group.columns]
            for _, own in groupby(sorted((d, u, s) for u, s, d in zip(*cols[1:], strict=True) if len(d) == CHECKED), key=itemgetter(0)):
                plain += [(u, s, 0) for _, u, s in list(own)[1:]]  # all but the first of equal strings
            short = [len(d) < WIDTH for d in cols[3]]
            plain += [(u, s, int(np.frombuffer(d, "<u4")[0])) for u, s, d, x in zip(*cols[1:], short, strict=True) if x and len(d) != CHECKED]
            keep = [i for i, x in enumerate(short) if not x]
            if len(keep) > 1:
                for whole, own in zip(held, cols, strict=True):
                    whole.extend(own[i] for i in keep)
                size += sum(len(cols[3][i]) for i in keep)
            if size >= SHARD:
                if out := solved(*held):
                    yield _rows(out)
                held, size = [[], [], [], []], 0
        if size and (out := solved(*held)):
            yield _rows(out)
        if plain:
            dup = _ranges(*(np.array(x, dtype=np.int64) for x in zip(*plain, strict=True)))
            yield _rows([(b, DUP, 0, x.tobytes()) for b, x in _dealt(dup, home(dup["uid"], buckets))])

    return kernel


def covered(ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, past the last) byte of the maximal runs that the strings of ``ranges`` (by start) cover."""
    lo = ranges["start"].astype(np.int64)
    hi = np.maximum.accumulate(lo + ranges["more"] + WIDTH)
    new = np.flatnonzero(np.concatenate(([True], lo[1:] > hi[:-1])))
    return lo[new], hi[np.append(new[1:], len(lo)) - 1]


def _removed(make, schema: pa.Schema):
    """Step 4: ``make(doc_id, text, first, past)`` gives the row of each document."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64)
        for group in _by_bucket(batches):
            asked = Asked(group[DUP], RANGE)
            for blob in group[TEXT]:
                rows = []
                for uid, doc, text in _opened(blob):
                    own = asked.of(uid)
                    rows.append(make(doc, text, *(covered(own) if len(own) else (none, none))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return kernel


def kept_bytes(text: bytes, first: np.ndarray, past: np.ndarray) -> bytes:
    out, at = [], 0
    for a, b in zip(first.tolist(), past.tolist(), strict=True):
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _digest(doc: int | None, text: bytes, first: np.ndarray, past: np.ndarray) -> tuple:
    return doc, len(text), int((past - first).sum()), len(first), hashlib.sha256(kept_bytes(text, first, past)).hexdigest()


def _text(doc: int | None, text: bytes, first: np.ndarray, past: np.ndarray) -> tuple:
    """The remaining text; characters of which a part was removed go too."""
    kept = kept_bytes(text, first, past) if len(first) else text
    return doc, kept.decode("utf-8", "ignore"), len(first)


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
TEXTS = pa.schema([("uid", pa.int64()), ("kept_text", pa.string()), ("n_spans", pa.int64())])


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, doc_id, text) with a unique uid that follows doc_id; nulls come first, repeated ids in the order of their texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = rows.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("u")).first()
    if ids.n == ids.u:
        return rows.select(F.col("doc_id").alias("uid"), "doc_id", "text")
    ranged = rows.repartitionByRange(max(1, docs.rdd.getNumPartitions()), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return table(ranged.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"), "numbered")


def _repeats(rows: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(ranges by home bucket, texts by home bucket) of (uid, doc_id, text)."""
    texts = rows.mapInArrow(_blobs(buckets), ROW)
    scanned = rows.select("uid", "text").mapInArrow(_scan(buckets), ROW)
    classes = table(scanned.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_classes(buckets), ROW), "spans-classes")
    asked = classes.where(F.col("kind") == ASK).unionByName(texts).repartition("bucket").sortWithinPartitions("bucket", "kind")
    held = asked.mapInArrow(_fetch(buckets), "key long, uid long, start long, data binary")
    found = table(held.repartition("key").sortWithinPartitions("key").mapInArrow(_shards(buckets), ROW), "spans-shards")
    return classes.where(F.col("kind") == DUP).unionByName(found), texts


def _solve(rows: DataFrame, make, schema: pa.Schema, ddl: str, buckets: int) -> DataFrame:
    ranges, texts = _repeats(rows, buckets)
    return ranges.unionByName(texts).repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_removed(make, schema), ddl)


def _buckets(docs: DataFrame) -> int:
    return 3 * max(4, docs.rdd.getNumPartitions())


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row for each row of ``docs``.

    Null texts count as empty.  Texts shorter than WIDTH lose nothing.  Rows of one id are
    documents of their own that follow each other in the order of their texts.
    """
    rows = _identified(docs, id_col, text_col)
    return _solve(rows, _digest, DIGEST, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", buckets or _buckets(docs))


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """The rows of ``docs`` with repeated passages taken out of their texts; all columns stay.

    A text of which nothing is left stays as an empty text, and null texts stay null.  Rows
    with null or repeated ids are documents of their own, in the order that ``spans`` gives them.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    rest = F.struct(packed(docs, (text_col,)).alias("row"), text.isNull().alias("null")) if len(docs.columns) > 1 else F.struct(text.isNull().alias("null"))
    ids = docs.agg(F.count("*").alias("n"), F.countDistinct(doc_id).alias("u")).first()
    if ids.n == ids.u:
        rows = docs.select(rest.alias("rest"), doc_id.alias("uid"), text.alias("text"))
    else:
        ranged = docs.repartitionByRange(max(1, docs.rdd.getNumPartitions()), doc_id, F.xxhash64(text)).sortWithinPartitions(doc_id, F.xxhash64(text), text)
        rows = table(ranged.select(rest.alias("rest"), F.monotonically_increasing_id().alias("uid"), text.alias("text")), "numbered")
    kept = _solve(rows.select("uid", F.col("uid").alias("doc_id"), "text"), _text, TEXTS, "uid long, kept_text string, n_spans long", buckets or _buckets(docs))
    out = rows.select("uid", "rest").join(kept, "uid")
    new = F.when(~F.col("rest.null"), F.col("kept_text")).alias(text_col)
    return out.select(*[new if c == text_col else F.col("rest.row").getField(c).alias(c) for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    """``spans`` with its own columns; nulls, repeated ids and empty tables are as there."""
    return spans(docs)

