"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's ``top`` most frequent 1- to 3-grams.  A document's own
list is compared to each profile by the out-of-place distance: the sum over its n-grams of
the difference between their ranks, or ``top`` where the profile lacks the n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import remainder, sliced
from seqloom.llm.tokens import forget

TOP = 400
UNKNOWN = "und"
_GAP = np.uint64(1)
_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> np.ndarray:
    """Codes of the 1- to 3-grams of ``text``: 21 bits for each letter, white space as one mark.

    Letters are lower-cased; every run of other characters is one gap, and there is a gap at
    both ends.  Empty without letters.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _LETTER[points]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    marks = np.where(letter, points, 1).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    marks = marks[keep]
    marks = np.concatenate(([_GAP] if marks[0] != _GAP else [], marks, [_GAP] if marks[-1] != _GAP else [])).astype(np.uint64)
    two = (marks[:-1] << np.uint64(21)) | marks[1:]
    three = (two[:-1] << np.uint64(21)) | marks[2:]
    return np.concatenate((marks[marks != _GAP], two, three))


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` codes by count, ties to the smaller code."""
    return codes[np.lexsort((codes, -counts))[:top]]


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[at], np.diff(np.concatenate((at, [len(codes)])))


class Profiles:
    """Ranks of every profile's n-grams, side by side, so that one search serves all languages."""

    def __init__(self, lists: dict[str, np.ndarray], top: int = TOP) -> None:
        self.names, self.top = sorted(lists), top
        self.codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *lists.values()]))
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, dtype=np.int32)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, lists[name]), k] = np.arange(len(lists[name]))

    def classify(self, text: str | None) -> tuple[str, float]:
        """The nearest language (ties: the first by name) and how far ahead it is of the next, 0 to 1."""
        codes = grams(text or "")
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(*counted(codes), self.top)
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(own), dtype=np.int32)[:, None])).sum(axis=0)
        order = np.argsort(apart, kind="stable")
        first = int(apart[order[0]])
        second = int(apart[order[1]]) if len(order) > 1 else self.top * len(own)
        return self.names[order[0]], 1.0 - first / second if second else 0.0


def learn(docs: DataFrame, held_out: int = 2, modulus: int = 4, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles from all texts of each language.

    Rows whose crc32(id as text) mod ``modulus`` is ``held_out``, and null texts or languages,
    are not used.  The profiles, ``top`` n-grams for each language, are all that
    reaches the driver.  N-grams of one count stand by their codes.  An empty table, or texts without
    letters, give no profiles, and then every text is ``und``.
    """
    rows = docs.where(remainder(F.col(id_col), modulus) != held_out).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    chosen = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1, 4 << 20):
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(grams(text))
            for lang, found in by.items():
                if len(codes := np.concatenate(found)):
                    codes, counts = counted(codes)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "code", "n"])

    totals = chosen.mapInArrow(kernel, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    best: dict[str, list[tuple[int, int]]] = {}
    for r in totals.withColumn("rank", rank).where(F.col("rank") <= top).collect():
        best.setdefault(r.lang, []).append((r["rank"], r.code))
    return Profiles({lang: np.array([c for _, c in sorted(found)], dtype=np.int64).view(np.uint64) for lang, found in best.items()}, top)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for each row; ``und`` and 0 for null texts and texts without letters."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            found = [profiles.classify(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(kernel, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language by a score of ``least`` or more.

    Null and empty texts and texts without letters go; repeated rows and null ids stay as they are.
    """
    names = [f.name for f in docs.schema.fields]
    at = [i for i, n in enumerate(names) if n == text_col][0]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in sliced(batches, at):
            found = [profiles.classify(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(kernel, docs.schema)


def query(docs: DataFrame) -> DataFrame:
    found = identify(docs, learn(docs))
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
