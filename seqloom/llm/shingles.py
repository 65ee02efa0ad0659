"""Near copies by the Jaccard similarity of word shingles: SimHash and min-hash bands propose, whole shingle sets decide.

Two texts are linked if their sets of ``WORDS``-word shingles are similar to ``NEAR`` or more.
Texts with one set are one node.  Nodes whose SimHash fingerprints differ in few bits (``simhash.links``, all of them found
by pigeonhole blocks) become candidates; pairs near 0.8 mostly differ in more bits, so nodes that agree in any of ``BANDS`` bands of ``ROWS`` min-hashes
become candidates too: a pair of similarity 0.8 has none in common with probability
(1 - 0.8^5)^32 = 3e-6.  Candidates hang together in coarse components, and each node's whole set
goes to its component once; there the links are computed exactly, and a spanning forest
of them is emitted, never all pairs.  A component above a task's size is dealt to pairs of
chunks, so every pair still meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm import simhash
from seqloom.llm.common import numbered, sliced, sorted_groups, text_of
from seqloom.llm.tokens import forget
from seqloom.operators.components import connected_components
from seqloom.plans.recovery import cut, table

WORDS, NEAR = 5, 0.8
BANDS, ROWS = 32, 5
MEMBERS, HASHES = 2048, 1 << 21  # nodes and shingles of a chunk
_RNG = np.random.default_rng(42)
_TIMES = _RNG.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of ``text``; a text of fewer words has one.  A-Z are lower-cased."""
    found = text.lower().split()
    joined = b" ".join(found)
    ends = list(accumulate(map(len, found), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[words - 1 :] or [len(joined)]
    h = xxhash.xxh64_intdigest
    return np.unique(np.array([h(joined[a:b], 42) for a, b in zip(starts, ends, strict=False)], dtype="<u8"))


def bands(held: np.ndarray, chunk: int = 2048) -> list[int]:
    """One signed 64-bit value for each band of min-hashes of a set."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(held), chunk):
        np.minimum(low, (held[None, at : at + chunk] * _TIMES + _PLUS).min(axis=1), out=low)
    data, size = low.tobytes(), 8 * ROWS
    return [xxhash.xxh64_intdigest(data[i * size : (i + 1) * size], i) - (1 << 63) for i in range(BANDS)]


def forest(sets: list[np.ndarray], near: float = NEAR) -> tuple[list[int], list[int]]:
    """Index pairs that span the links among ``sets``."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(int(flat.max()) + 1, dtype=bool)
    left, outs, ins, front = np.ones(len(sets), dtype=bool), [], [], []
    while left.any():
        x = front.pop() if front else int(left.argmax())
        left[x] = False
        own = flat[starts[x] : starts[x] + sizes[x]]
        mark[own] = True
        common = np.add.reduceat(mark[flat], starts, dtype=np.int64)
        mark[own] = False
        hit = np.flatnonzero(left & (common >= near * (sizes + sizes[x] - common) - 1e-9)).tolist()
        left[hit] = False
        front.extend(hit)
        outs += [x] * len(hit)
        ins += hit
    return outs, ins


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in sliced(batches, 1):
        same, sizes, fps, keys = [], [], [], []
        for t in batch.column(1).to_pylist():
            held = shingles(text_of(t))
            same.append(xxhash.xxh3_64_intdigest(held.tobytes()) - (1 << 63))
            sizes.append(len(held))
            fps.append(simhash.voted(held))
            keys.append(bands(held))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.int64()), pa.array(sizes, pa.int64()), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], ["uid", "same", "size", "fp", "keys"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in sliced(batches, 4):
        held = [shingles(text_of(t)).tobytes() for t in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(held, pa.binary())], ["node", "component", "own", "parts", "held"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in sorted_groups(batches):
        if group.num_rows > 1:
            node = group.column(1).to_numpy()
            a, b = forest([np.frombuffer(x, "<u8") for x in group.column(2).to_pylist()])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["src", "dst"])


def candidates(nodes: DataFrame) -> DataFrame:
    """(src, dst) that hang candidates among (node, fp, keys) together: by near fingerprints, by equal ones, and by a band in common."""
    first = cut(nodes.groupBy("fp").agg(F.min("node").alias("src"), F.count("*").alias("n")))
    near = simhash.links(first.select(F.col("src").alias("node"), "fp"))
    equal = nodes.select("node", "fp").join(first.where("n > 1").select("fp", "src"), "fp").where("node <> src").select("src", F.col("node").alias("dst"))
    keyed = nodes.select(F.explode("keys").alias("key"), "node")
    shared = keyed.groupBy("key").agg(F.min("node").alias("src"), F.count("*").alias("n")).where("n > 1").select("key", "src")
    bands = keyed.join(shared, "key").where("node <> src").select("src", F.col("node").alias("dst"))
    return near.unionByName(equal).unionByName(bands).distinct()


def firsts(rows: DataFrame, members: int = MEMBERS, hashes: int = HASHES) -> DataFrame:
    """(uid): the smallest uid of each class of near copies among ``rows`` (uid, text); uids are unique.

    Null and empty texts and those without words share one empty shingle and so one class; without rows the result is empty.
    """
    signed = rows.select("uid", "text").mapInArrow(_signed, "uid long, same long, size long, fp long, keys array<long>")
    nodes = table(signed.groupBy("same").agg(F.min("uid").alias("node"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("keys").alias("keys")).drop("same"), "shingle-bands")
    coarse = cut(connected_components(candidates(nodes)))
    sized = coarse.join(nodes.select("node", "size"), "node")
    load = F.greatest(F.count("*") / members, F.sum("size") / hashes)
    parts = sized.groupBy("component").agg(F.ceil(load).cast("int").alias("parts"))
    dealt = coarse.join(parts, "component").select(F.col("node").alias("uid"), "component", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("own"), "parts")
    sets = rows.join(dealt, "uid").select(F.col("uid").alias("node"), "component", "own", "parts", "text")
    sets = sets.mapInArrow(_sets, "node long, component long, own int, parts int, held binary")
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sets = sets.select(F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "node", "held")
    found = connected_components(sets.repartition("key").sortWithinPartitions("key").mapInArrow(_links, "src long, dst long"))
    gone = found.where("node <> component").select("node")
    return cut(nodes.select("node").join(gone, "node", "left_anti").select(F.col("node").alias("uid")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row of each class of near copies; all columns stay.

    Rows with null or repeated ids are documents of their own, in the order of ``numbered``.
    """
    rows = numbered(docs, id_col, text_col)
    return rows.join(firsts(rows.select("uid", "text")), "uid", "left_semi").select("row.*")
