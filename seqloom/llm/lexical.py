"""Ranked lexical search: document-at-a-time over compressed postings, shard by shard.

The index holds, for each shard (texts of about ``SHARD`` bytes that one task read), a row for each term with its postings: the
documents' places in ascending doc_id order as gaps, and the term's occurrences, both in groups of seven bits.  One more row
a shard, without a term, has the ids and lengths.  A search takes the postings of the items' terms, a block of items at a
time: cursors over the postings meet in a heap that yields one document after the other; a second heap, bounded at k, keeps the
best by score, then smaller doc_id.  Lists that cannot lift a document over the k-th best score leave the merge and are only looked
up.  The shards' results are merged by rank.

Rows without a term (null or empty texts) are no documents.  Each row is a document of its own, repeated rows too; null
ids come last among equal scores.  Each row of ``items`` is a query of its own; items without a known term have no rows.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush, heapreplace, nlargest

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import give_back, if_small, sliced, sorted_groups
from seqloom.llm.terms import ALNUM, sql_terms, terms
from seqloom.plans.recovery import cut, table

SHARD = 16 << 20
#: Items, about, whose postings of one shard are in a task at a time.
BLOCK = 256
_ROWS = 20_000
_INDEX = pa.schema([("shard", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("total", pa.int64()), ("postings", pa.binary()), ("ids", pa.binary())])


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of unsigned values, seven bits each and the low ones first, and where each value ends."""
    values = values.astype(np.uint64)
    width = np.ones(len(values), dtype=np.int64)
    for k in range(1, 5):
        width += values >= np.uint64(1 << 7 * k)
    end = np.cumsum(width)
    out = np.zeros(int(end[-1]) if len(end) else 0, dtype=np.uint8)
    for k in range(5):
        at = width > k
        out[(end - width)[at] + k] = (values[at] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8) | np.where(width[at] > k + 1, 128, 0).astype(np.uint8)
    return out, end


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    end = np.flatnonzero(raw < 128)
    start = np.concatenate(([0], end[:-1] + 1)).astype(np.int64)
    out = np.zeros(len(end), dtype=np.int64)
    for k in range(5):
        at = start + k <= end
        out[at] |= (raw[start[at] + k] & 127).astype(np.int64) << 7 * k
    return out


class Shard:
    """Documents on their way into the index."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.known: dict[bytes, int] = {}
        self.term, self.times, self.distinct, self.length, self.size = array("I"), array("I"), array("I"), array("Q"), 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        if not (words := terms(text, ALNUM)):
            return
        found, known = Counter(words), self.known
        self.term.extend([known.setdefault(w, len(known)) for w in found])
        self.times.extend(found.values())
        self.ids.append(doc_id)
        self.distinct.append(len(found))
        self.length.append(len(words))
        self.size += len(text)

    def rows(self, name: str) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        nulls = np.array([i is None for i in self.ids])
        ids = np.array([0 if i is None else i for i in self.ids], dtype=np.int64)
        order = np.lexsort((ids, nulls))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        length = np.frombuffer(self.length, dtype=np.uint64)[order]
        lengths, _ = packed(length)
        # The ids of the shard; as many of the last places as the flags say have none.
        head = np.int64(nulls.sum()).tobytes() + ids[order].astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(([name], [None], [len(order)], [int(length.sum())], [lengths.tobytes()], [head]), _INDEX.types, strict=True)], schema=_INDEX)
        term, doc = np.frombuffer(self.term, dtype=np.uint32), np.repeat(place, np.frombuffer(self.distinct, dtype=np.uint32))
        by = np.lexsort((doc, term))
        term, doc, times = term[by], doc[by], np.frombuffer(self.times, dtype=np.uint32)[by]
        first = np.flatnonzero(np.diff(term, prepend=np.uint32(0xFFFFFFFF)))
        gap = np.diff(doc, prepend=0)
        gap[first] = doc[first]
        data, end = packed(np.stack((gap, times), axis=1).ravel())
        held, upto = data.tobytes(), np.concatenate(([0], end[1::2])).tolist()
        edge = [*first.tolist(), len(term)]
        names = list(self.known)  # in the order of their numbers
        for lo in range(0, len(names), _ROWS):
            hi = min(lo + _ROWS, len(names))
            cuts = edge[lo : hi + 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (hi - lo), pa.string()), pa.array(names[lo:hi], pa.binary()).cast(pa.string()), pa.array(np.diff(cuts), pa.int64()), pa.nulls(hi - lo, pa.int64()),
                    pa.array([held[upto[a] : upto[b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), pa.nulls(hi - lo, pa.binary()),
                ], schema=_INDEX,
            )


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """(shard, term, docs, total, postings, ids), written to the shared folder; the texts are read once and never shuffled."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held = TaskContext.get().partitionId(), 0, Shard()
        for batch in sliced(batches, 1):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.add(doc_id, text)
                if held.size >= shard:
                    yield from held.rows(f"{task}.{n}")
                    held, n = Shard(), n + 1
        yield from held.rows(f"{task}.{n}")
        held = None
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return table(rows.mapInArrow(kernel, "shard string, term string, docs long, total long, postings binary, ids binary"), "postings")


def best(lists: list[tuple[list[int], list[int]]], k: int, limit: int = 0) -> list[tuple[int, int]]:
    """The k highest (score, place) above ``limit``, equal scores by smaller place, of lists of (places ascending, gains)."""
    lists = sorted(((max(g), d, g) for d, g in lists if d), key=lambda x: -x[0])
    docs, gains = [x[1] for x in lists], [x[2] for x in lists]
    rest = [0] * (len(lists) + 1)  # what the lists from i on can give together
    for i in range(len(lists) - 1, -1, -1):
        rest[i] = rest[i + 1] + lists[i][0]
    live = len(lists)
    while live and rest[live - 1] <= limit:
        live -= 1
    at = [0] * len(lists)
    merge = [(docs[i][0], i) for i in range(live)]
    heapify(merge)
    found: list[tuple[int, int]] = []
    while merge and live:
        doc, score = merge[0][0], 0
        while merge and merge[0][0] == doc:
            i = merge[0][1]
            p = at[i]
            score += gains[i][p]
            at[i] = p = p + 1
            if i < live and p < len(docs[i]):
                heapreplace(merge, (docs[i][p], i))
            else:
                heappop(merge)
        for i in range(live, len(lists)):
            if score + rest[i] <= limit:
                break
            at[i] = p = bisect_left(docs[i], doc, at[i])
            if p < len(docs[i]) and docs[i][p] == doc:
                score += gains[i][p]
        if score > limit:
            if len(found) < k:
                heappush(found, (score, -doc))
            else:
                heapreplace(found, (score, -doc))
            if len(found) == k:
                limit = max(limit, found[0][0])
                while live and rest[live - 1] <= limit:
                    live -= 1
    return sorted(((s, -d) for s, d in found), key=lambda x: (-x[0], x[1]))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot, item, term, times = [], [], [], []
        for s, i, text in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            for word, n in Counter(terms(text, ALNUM)).items():
                slot.append(s), item.append(i), term.append(word), times.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(item, pa.int64()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], ["slot", "item_id", "term", "times"])


def search(postings: DataFrame, items: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each row of ``items``, all where fewer score above 0."""
    slots = items.select(F.monotonically_increasing_id().alias("slot"), F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    words = cut(slots.mapInArrow(_words, "slot long, item_id long, term string, times long"))
    shards = postings.where("term IS NULL")
    total = shards.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = int(total.n), max(int(total.l), 1)
    blocks = max(1, -(-words.agg(F.countDistinct("slot")).first()[0] // block))
    known = postings.where("term IS NOT NULL").join(if_small(words.select("term").distinct()), "term", "left_semi")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = known.groupBy("term").agg(F.sum("docs").alias("df")).select("term", weight.alias("w")).where("w > 0")
    block_of = F.pmod(F.xxhash64("slot"), F.lit(blocks)).cast("int").alias("block")
    uses = words.join(weights, "term").select("term", "w", block_of, F.struct("slot", "item_id", "times").alias("use")).groupBy("term", "block").agg(F.first("w").alias("w"), F.collect_list("use").alias("uses"))
    uses = cut(uses)
    rows = postings.where("term IS NOT NULL").join(if_small(uses), "term").select("shard", "block", "term", "postings", "ids", "w", "uses")
    heads = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "term", "postings", "ids", F.lit(None).cast("long").alias("w"), F.lit(None).cast(uses.schema["uses"].dataType).alias("uses"))
    dealt = heads.unionByName(rows).select(F.concat_ws(".", "shard", "block").alias("key"), "term", "postings", "ids", "w", "uses")
    dealt = dealt.repartition("key").sortWithinPartitions("key", F.col("term").asc_nulls_first())

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores: dict[int, list[int]] = {}  # the best scores so far of each item that this task has met
        for group in sorted_groups(batches):
            head = group.column(2)[0].as_py()
            ids = np.frombuffer(group.column(3)[0].as_py(), dtype="<i8")
            nulls, ids = int(ids[0]), ids[1:]
            share = 12 * (75 + (25 * unpacked(head) * n_docs) // n_terms)
            by: dict[tuple[int, int | None], list[tuple[int, int]]] = {}
            decoded = []
            for data, w, found in zip(group.column(2)[1:].to_pylist(), group.column(4)[1:].to_pylist(), group.column(5)[1:].to_pylist(), strict=True):
                pairs = unpacked(data)
                place, times = np.cumsum(pairs[0::2]), pairs[1::2]
                for use in found:
                    by.setdefault((use["slot"], use["item_id"]), []).append((len(decoded), w * use["times"]))
                decoded.append((place, 1_000_000_000 * times // (1000 * times + share[place])))
            out: list[tuple[int, int | None, int | None, int]] = []
            for (slot, item), own in by.items():
                held = scores.get(slot, [])
                # A document of an equal score may still win by its id.
                least = held[-1] - 1 if len(held) == k else 0
                won = best([(decoded[t][0].tolist(), (decoded[t][1] * w).tolist()) for t, w in own], k, max(least, 0))
                scores[slot] = nlargest(k, held + [s for s, _ in won])
                out += [(slot, item, int(ids[p]) if p < len(ids) - nulls else None, s) for s, p in won]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["slot", "item_id", "doc_id", "score"])

    found = dealt.mapInArrow(kernel, "slot long, item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(index(docs), items)


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE = f"""
WITH word AS (SELECT doc_id, unnest({sql_terms('text', _PATTERN)}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM word GROUP BY doc_id, term),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS l FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
part AS (SELECT item_id, unnest({sql_terms('text', _PATTERN)}) AS term FROM benchmark),
use AS (SELECT item_id, term, count(*) AS times FROM part GROUP BY item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * tot.n + 2) / (2.0 * df + 1))) AS BIGINT) AS w FROM df, tot),
gain AS (SELECT u.item_id, t.doc_id,
  CAST(sum(u.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * len.n * tot.n) // tot.l)))) AS BIGINT) AS score
  FROM use u JOIN w USING (term) JOIN tf t USING (term) JOIN len USING (doc_id), tot GROUP BY u.item_id, t.doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM gain WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""
