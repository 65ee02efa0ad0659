"""Packing documents into fixed windows by mixture-controlled deficit round-robin.

Documents are dealt to lanes by the hash of their ids, so each lane holds a fair part of
every source.  In a lane, each source has a queue and a deficit: every placed token adds
the source's target share to all deficits and takes one from its own.  The source with the
largest deficit places up to ``quantum`` tokens at a time until the window is full, and
deficits go on into the next window.  A lane starts with the deficits that the lanes before it
leave, which follow from prefix sums of token counts; so do its first window's number.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import give_back, sliced
from seqloom.llm.tokens import encoder
from seqloom.plans.recovery import cut, table

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Lane:
    """The scheduler of one lane; ``shares`` and ``deficits`` are by source number."""

    def __init__(self, shares: np.ndarray, deficits: np.ndarray, first: int, window: int, quantum: int) -> None:
        self.shares, self.deficits, self.window, self.quantum = shares, deficits.astype(np.float64), window, quantum
        self.queues: list[deque] = [deque() for _ in shares]
        self.sequence, self.used = first, 0
        self.left = 0

    def add(self, source: int, doc: tuple) -> None:
        """``doc`` is (doc_id, ids)."""
        self.queues[source].append(doc)
        self.left += len(doc[1])

    def pieces(self) -> Iterator[tuple]:
        """(doc_id, start, ids, doc_tokens, sequence, offset) until the queues are empty."""
        # A source without documents stands at minus infinity, whatever is added.
        deficits = np.where([bool(q) for q in self.queues], self.deficits, -np.inf)
        at = [0] * len(self.queues)
        open_piece: list | None = None
        while self.left:
            s = int(deficits.argmax())
            doc = self.queues[s][0]
            n = min(self.quantum, len(doc[1]) - at[s], self.window - self.used)
            if open_piece and open_piece[0] is doc:
                open_piece[2] += n
            else:
                if open_piece:
                    yield self._piece(open_piece)
                open_piece = [doc, at[s], at[s] + n, self.sequence, self.used]
            deficits += self.shares * n
            deficits[s] -= n
            at[s] += n
            self.used += n
            self.left -= n
            if at[s] == len(doc[1]):
                self.queues[s].popleft()
                at[s] = 0
                if not self.queues[s]:
                    deficits[s] = -np.inf
            if self.used == self.window:
                yield self._piece(open_piece)
                open_piece, self.used = None, 0
                self.sequence += 1
        if open_piece:
            yield self._piece(open_piece)

    @staticmethod
    def _piece(p: list) -> tuple:
        doc, lo, hi, sequence, offset = p
        return doc[0], lo, doc[1][lo:hi], len(doc[1]), sequence, offset


def _batch(held: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*held, strict=True))
    crc = [zlib.crc32(ids.astype("<u4")) for ids in cols[2]]
    values = [cols[0], cols[1], [len(x) for x in cols[2]], crc, *cols[3:]]
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, quantum: int = 512, weights: dict | None = None, lanes: int | None = None, remember: int = 1_500_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``weights`` gives sources' target shares of the tokens; by default each source has the
    share that it holds.  Null texts count as empty (one end token), null sources as one
    source.  Rows of one id, or without one, go to lanes by their texts; repeated rows are packed as often as they come.  Only the last window
    of each lane may be short.  What a task holds is one lane's ids, and each worker ``remember``
    pieces of text with their ids.
    """
    lanes = lanes or 4 * max(1, docs.rdd.getNumPartitions())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    rows = docs.select(F.pmod(F.xxhash64(doc_id, text, F.lit("lane")), F.lit(lanes)).cast("int").alias("lane"), doc_id.alias("doc_id"), F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")).alias("source"), text.alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, remember)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for batch in sliced(batches, 3, 4 << 20):
            data = [d + end for d in enc.encode(batch.column(3))]
            sizes = pa.array([len(d) // enc.dtype.itemsize for d in data], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], sizes, pa.array(data, pa.binary())], ["lane", "doc_id", "source", "n", "ids"])

    coded = table(rows.mapInArrow(encode, "lane int, doc_id long, source string, n long, ids binary"), "packing", 1)
    # One row for each lane and source, whatever the number of documents.
    counts = cut(coded.groupBy("lane", "source").agg(F.sum("n").alias("n")))
    before = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    per_lane = counts.groupBy("lane").agg(F.sum("n").alias("all"))
    per_lane = per_lane.select("lane", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("all_before"), F.coalesce(F.sum(F.ceil(F.col("all") / window)).over(before), F.lit(0)).alias("first"))
    if weights is None:
        shares = counts.groupBy("source").agg(F.sum("n").alias("w"))
    else:
        shares = counts.groupBy("source").agg(F.first("source").alias("s")).select("source", F.lit(0.0).alias("w"))
        for name, w in weights.items():
            shares = shares.withColumn("w", F.when(F.col("source") == ("" if name is None else f"s{name}"), float(w)).otherwise(F.col("w")))
    whole = float(shares.agg(F.sum("w")).first()[0] or 1)
    shares = shares.select("source", (F.col("w") / whole).alias("share"))
    own = Window.partitionBy("source").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    heads = counts.withColumn("own_before", F.coalesce(F.sum("n").over(own), F.lit(0))).join(per_lane, "lane").join(shares, "source")
    heads = heads.select("lane", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), "source", F.lit(None).cast("binary").alias("ids"), "share", (F.col("share") * F.col("all_before") - F.col("own_before")).alias("deficit"), "first")
    body = coded.select("lane", F.lit(1).alias("kind"), "doc_id", "source", "ids", F.lit(0.0).alias("share"), F.lit(0.0).alias("deficit"), F.lit(0).cast("long").alias("first"))
    dealt = heads.unionByName(body).repartition("lane").sortWithinPartitions("lane", "kind", "source", "doc_id", F.xxhash64("ids"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer, remember).dtype
        lane, now, number, heads = None, -1, {}, []

        def drained() -> Iterator[pa.RecordBatch]:
            held = []
            for piece in lane.pieces() if lane else ():
                held.append(piece)
                if len(held) == 4096:
                    yield _batch(held)
                    held = []
            if held:
                yield _batch(held)

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for at, kind, doc, source, ids, share, deficit, first in zip(*cols, strict=True):
                if at != now:
                    yield from drained()
                    lane, now, number, heads = None, at, {}, []
                if kind == 0:
                    number[source] = len(heads)
                    heads.append((share, deficit, first))
                    continue
                if lane is None:
                    lane = Lane(np.array([h[0] for h in heads]), np.array([h[1] for h in heads]), heads[0][2], window, quantum)
                lane.add(number[source], (doc, np.frombuffer(ids, dtype=dtype)))
        yield from drained()
        lane = None
        give_back()

    return dealt.mapInArrow(kernel, PIECES)


def query(docs: DataFrame, tokenizer: str) -> DataFrame:
    return pack(docs, tokenizer)
