"""Quality classification by nearest-neighbour voting among latent-semantic vectors.

A text's terms are its hashed byte 3-grams, 3-grams of its shape (letters, capitals,
digits and marks, runs of letters as one) and, as terms of their own, how often its words and lines
repeat.  Damped counts are weighted by rarity and projected on the leading
right singular vectors of a bounded sample of labelled texts.  Every document is compared to
all labelled vectors in blocks of exact cosines, and the nearest vote by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import remainder, sliced, text_of

#: Labelled texts that are learned from, at most.  What reaches the driver and what is broadcast are
#: LABELLED rows of TERMS or DIMENSIONS numbers, however long the texts are.
LABELLED = 3000
TERMS = 2048
DIMENSIONS = 48
NEIGHBOURS = 15
STEPS = 16  # repeat terms
CHUNK = 1 << 20  # symbols that are counted at a time
_FOLD = np.uint32(0x9E3779B1)
#: Bytes as shapes: small letters and what is beyond ASCII 1, capitals 2, digits 3, all others themselves.
_SHAPE = np.array([2 if 65 <= b <= 90 else 1 if 97 <= b <= 122 or b > 127 else 3 if 48 <= b <= 57 else b if b > 3 else 4 for b in range(256)], dtype=np.uint8)


def _repeats(data: bytes) -> list[int]:
    """Which repeat terms a text has: its share of distinct words, three-word runs and lines, in steps."""
    words = data.split()
    if not words:
        return [3 * STEPS]
    runs = len(set(zip(words, words[1:], words[2:], strict=False)))
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = lambda n, distinct: min(STEPS - 1, STEPS * (n - distinct) // max(1, n))
    return [share(len(words), len(set(words))), STEPS + share(max(0, len(words) - 2), runs), 2 * STEPS + share(len(lines), len(set(lines)))]


def _tally(symbols: np.ndarray, row: np.ndarray, live: np.ndarray, rows: int, half: int) -> np.ndarray:
    """Counts, by row, of the terms of three symbols that begin at ``live`` ones."""
    wide = symbols.astype(np.uint32)
    h = (wide[:-2] | (wide[1:-1] << np.uint32(8)) | (wide[2:] << np.uint32(16)) | np.uint32(half << 24)) * _FOLD
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    at = (h >> np.uint32(16)).astype(np.int64) % (TERMS // 2) + half * (TERMS // 2) + row[:-2].astype(np.int64) * TERMS
    return np.bincount(at[live[:-2]], minlength=rows * TERMS).reshape(rows, TERMS)


def _grouped(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes, or of one text."""
    lo = size = 0
    for hi, t in enumerate(texts):
        if hi > lo and size + len(t) > CHUNK:
            yield lo, hi
            lo, size = hi, 0
        size += len(t)
    if texts:
        yield lo, len(texts)


def counts(texts: list[bytes]) -> np.ndarray:
    """Damped term counts, one row for each text, of unit length before rarity weights.

    A row depends on its own whole text alone.  A long text takes about ten times its size, and its
    words as objects while their repeats are counted.
    """
    out = np.zeros((len(texts), TERMS + 3 * STEPS + 1), dtype=np.float32)
    for lo, hi in _grouped(texts):
        raw = np.frombuffer(b"".join(t + b"\0\0" for t in texts[lo:hi]), dtype=np.uint8)
        sizes = np.array([len(t) + 2 for t in texts[lo:hi]], dtype=np.int64)
        ends = np.cumsum(sizes)
        row, live = np.repeat(np.arange(hi - lo, dtype=np.int32), sizes), np.ones(len(raw), dtype=bool)
        live[ends - 1] = live[ends - 2] = False
        shape = _SHAPE[raw]
        keep = np.concatenate(([True], (shape[1:] != shape[:-1]) | (shape[1:] > 2)))
        for half, parts in enumerate(((raw, row, live), (shape[keep], row[keep], live[keep]))):
            for at in range(0, len(parts[0]) - 2, CHUNK):
                out[lo:hi, :TERMS] += _tally(*(x[at : at + CHUNK + 2] for x in parts), hi - lo, half)
    out = np.log1p(out)
    norm = np.sqrt((out**2).sum(axis=1, keepdims=True))
    out /= np.maximum(norm, 1e-9)
    for i, t in enumerate(texts):
        out[i, TERMS + np.array(_repeats(t))] = 0.3
    return out


class Model:
    """Rarity weights, the projection, and the labelled vectors (unit length) with their labels."""

    def __init__(self, terms: np.ndarray, labels: list[int]) -> None:
        self.empty = not len(terms)
        if self.empty:
            return
        self.rarity = np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))).astype(np.float32) + 1
        terms = terms * self.rarity
        self.mean = terms.mean(axis=0)
        terms -= self.mean
        values, vectors = np.linalg.eigh((terms.T @ terms).astype(np.float64))
        self.project = vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32)
        self.points = self._unit(terms @ self.project)
        self.labels = np.array(labels, dtype=np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-9)

    def score(self, texts: list[bytes], block: int = 512) -> np.ndarray:
        """The similarity-weighted share of label 1 among the nearest labelled texts; 0.5 without any."""
        out = np.full(len(texts), 0.5)
        if self.empty:
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for lo in range(0, len(texts), block):
            own = self._unit((counts(texts[lo : lo + block]) * self.rarity - self.mean) @ self.project)
            cosine = own @ self.points.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < cosine.shape[1] else np.broadcast_to(np.arange(k), (len(own), k))
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0) ** 4 + 1e-6
            out[lo : lo + block] = np.clip((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1), 0.0, 1.0)
        return out


def learn(docs: DataFrame, labels: DataFrame, held_out: int = 0, modulus: int = 5, most: int = LABELLED, label_col: str = "quality") -> Model:
    """A model from up to ``most`` labelled rows, those whose ids have the least hashes.

    Rows whose crc32(doc_id as text) mod ``modulus`` is ``held_out`` are not used, nor are null
    ids, texts or labels; of a repeated id the smallest label and the smallest text count.  Whole texts
    are counted where they lie, and only the counts go to the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label is not null")
    known = known.where(remainder(F.col("doc_id"), modulus) != held_out).groupBy("doc_id").agg(F.min("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id", F.lit("label")), "doc_id").limit(most)  # a top-k: each task sends its own ``most`` rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.first("label").alias("label"), F.min("text").alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2):
            held = [x.tobytes() for x in counts([text_of(t) for t in batch.column(2).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.binary())], ["doc_id", "label", "terms"])

    found = sorted((r.doc_id, r.label, bytes(r.terms)) for r in rows.mapInArrow(kernel, "doc_id long, label int, terms binary").collect())
    terms = np.frombuffer(b"".join(t for _, _, t in found), dtype=np.float32).reshape(len(found), -1) if found else np.zeros((0, 0), np.float32)
    return Model(terms, [1 if x == 1 else 0 for _, x, _ in found])


def classify(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) for each row; null texts are scored as empty ones.

    Equal texts get equal scores.  Where several labelled vectors are equally near at the end of the
    vote, which of them count is left to numpy's partition, the same on every run.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1, 4 << 20):
            score = shared.value.score([text_of(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(kernel, "doc_id long, score double, predicted int")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = classify(docs, learn(docs, labels))
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
