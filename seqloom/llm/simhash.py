"""SimHash near-duplicate classes: pigeonhole blocks, a verified Hamming distance, components.

The 64 fingerprint bits are cut into ``max_distance + 1`` blocks, so two fingerprints that
differ in at most ``max_distance`` bits agree in one block at least.  Rows meet by
block value; only distinct fingerprints take part, so exact copies cost one row.  A
block value that is shared by more than ``bucket`` fingerprints is cut again by a second
set of blocks over the bits outside the first one, and what is still larger is dealt
to pairs of chunks: every pair of fingerprints still meets in some task, no task
holds more than about two buckets, and each task emits a spanning forest of the links it
verified, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import numbered, sliced, sorted_groups, text_of
from seqloom.llm.tokens import forget
from seqloom.operators.components import connected_components
from seqloom.plans.recovery import cut

BITS = 64


def voted(hashes: np.ndarray, chunk: int = 1 << 16) -> int:
    """The bits that are set in over half of 64-bit hashes; 0 without any."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), chunk):
        counts += np.unpackbits(hashes[at : at + chunk].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, words: int = 4, chunk: int = 1 << 16) -> int:
    """Unsigned SimHash of the word shingles of ``text``; 0 without words.

    A-Z are lower-cased; a text of fewer words than a shingle counts as one shingle.
    """
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(accumulate(map(len, found), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[words - 1 :] or [len(joined)]
    counts, n, h = np.zeros(BITS, dtype=np.int64), len(ends), xxhash.xxh64_intdigest
    for at in range(0, n, chunk):
        values = np.array([h(joined[a:b], 42) for a, b in zip(starts[at : at + chunk], ends[at : at + chunk], strict=False)], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(doc_id, fp): one row for each row of ``docs``; fp holds the 64 bits as a signed long."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in sliced(batches, 1):
            found = [fingerprint(text_of(t), words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(kernel, "doc_id long, fp long")


def forest(bits: np.ndarray, most: int, small: int = 192) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that span the links (at most ``most`` differing bits) among ``bits``."""
    n = len(bits)
    if n <= small:
        a, b = np.nonzero(np.triu(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= most, 1))
        if len(a) <= 2 * n:
            return a, b
    left, outs, ins = np.arange(n), [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(bits[left] ^ bits[x]) <= most
            if near.any():
                hit, left = left[near], left[~near]
                front.extend(hit)
                outs.append(np.full(len(hit), x))
                ins.append(hit)
    empty = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(outs or empty), np.concatenate(ins or empty)


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, x)) for x in np.array_split(np.array(bits), parts)]


def _value(fp: Column, bits: list[int]) -> Column:
    """The bits ``bits`` (consecutive runs) of ``fp`` packed into one long."""
    out, at, k = F.lit(0).cast("long"), 0, 0
    while k < len(bits):
        run = 1
        while k + run < len(bits) and bits[k + run] == bits[k] + run:
            run += 1
        piece = F.shiftrightunsigned(fp, bits[k]).bitwiseAND(F.lit((1 << run) - 1).cast("long"))
        out, at, k = out.bitwiseOR(F.shiftleft(piece, at)), at + run, k + run
    return out


def links(nodes: DataFrame, most: int = 4, bucket: int = 1024) -> DataFrame:
    """(src, dst): node ids whose fingerprints differ in at most ``most`` bits.

    ``nodes`` is (node, fp) with distinct fp.  The edges span every component of the link
    graph; a component's other links are implied.
    """
    first = _blocks(list(range(BITS)), most + 1)
    keyed = nodes.select(
        F.explode(F.array(*[F.lit(i << 16).cast("long").bitwiseOR(_value(F.col("fp"), b)) for i, b in enumerate(first)])).alias("key"), "fp", "node"
    )
    # There are (most + 1) * 2**13 block values at most, whatever the input holds.
    hot = [r.key for r in keyed.groupBy("key").count().where(F.col("count") > bucket).select("key").collect()]
    if hot:
        heavy = F.broadcast(nodes.sparkSession.createDataFrame([(k,) for k in hot], "key long"))
        finer = keyed.join(heavy, "key", "left_semi")
        second = F.lit(None)
        for i, own in enumerate(first):
            rest = _blocks([b for b in range(BITS) if b not in own], most + 1)
            keys = F.array(*[F.xxhash64("key", F.lit(j), _value(F.col("fp"), b)) for j, b in enumerate(rest)])
            second = F.when(F.shiftright("key", 16) == i, keys).otherwise(second)
        finer = finer.select(F.explode(second).alias("key"), "fp", "node")
        parts = finer.groupBy("key").count().select("key", F.ceil(F.col("count") / bucket).cast("int").alias("parts")).where("parts > 1")
        finer = finer.join(parts, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        finer = finer.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        finer = finer.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        finer = finer.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp", "node")
        keyed = keyed.join(heavy, "key", "left_anti").unionByName(finer)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches):
            bits = group.column(1).to_numpy().view(np.uint64)
            node = group.column(2).to_numpy()
            if len(bits) > 1:
                a, b = forest(bits, most)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["src", "dst"])

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(kernel, "src long, dst long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, most: int = 4, bucket: int = 1024) -> DataFrame:
    """(doc_id, fp, component_id) for each row; component_id is the smallest doc_id reachable over links.

    Null and empty texts have fingerprint 0 and link like any other.  Rows with a null id
    keep their fingerprint and join the component of equal or near fingerprints if that has
    an id, else component_id is null.  Repeated rows stay repeated.  An empty table gives an
    empty result.
    """
    fps = cut(fingerprints(docs, id_col, text_col, words))
    nodes = fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    found = connected_components(links(nodes, most, bucket))
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    # Fingerprints that hold over a thousandth of the rows each, so under a thousand of them, are not dealt by their value.
    counted = fps.groupBy("fp").agg(F.count("*").alias("n"))
    hot = cut(counted.where(1000 * F.col("n") > fps.count()).select("fp"))
    out = fps.join(F.broadcast(hot), "fp", "left_anti").join(named, "fp", "left")
    out = out.unionByName(fps.join(F.broadcast(cut(hot.join(named, "fp", "left"))), "fp"))
    return out.select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, most: int = 4) -> DataFrame:
    """The first row of each near-duplicate class; all columns stay.

    Rows with null or repeated ids are documents of their own, in the order of ``numbered``.
    """
    rows = numbered(docs, id_col, text_col)
    classes = near_duplicates(rows, "uid", "text", words, most)
    return rows.join(cut(classes.where("doc_id = component_id").select(F.col("doc_id").alias("uid"))), "uid", "left_semi").select("row.*")


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
