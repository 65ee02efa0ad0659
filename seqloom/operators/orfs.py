"""Open reading frames: stop-free stretches of translated sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import codes


STOP = ord("*")
ORF = "strand string, shift long, beg long, end long, len long, aalen long, aa string"


def _stretches(aa: np.ndarray, least: int) -> list[tuple[int, int, str]]:
    """(first, last, amino acids) from 1 of the stretches between stops, with ``least`` or more known ones."""
    stops = np.concatenate(([-1], np.flatnonzero(aa == STOP), [len(aa)]))
    out = []
    for k in np.flatnonzero(np.diff(stops) > least).tolist():
        lo, hi = int(stops[k]) + 1, int(stops[k + 1])
        own = aa[lo:hi]
        own = own[own != codes.GAP]
        if len(own) >= least:
            out.append((lo + 1, hi, own.tobytes().decode()))
    return out


def _frames(text: str, least: int, strands: str, shifts: int) -> list[tuple]:
    """Rows of ORF for one sequence, whose frames are read off base codes that are computed once a strand."""
    seq, out = codes.symbols(text), []
    for strand in strands:
        own = codes.base_codes(seq if strand == "+" else codes.opposite(seq))
        for shift in range(shifts):
            for first, last, aa in _stretches(codes.codons(own, shift), least):
                beg, end = 3 * first - 2 + shift, 3 * last + shift
                place = (beg, end) if strand == "+" else (len(seq) - beg + 1, len(seq) - end + 1)
                out.append((strand, shift, *place, end - beg + 1, len(aa), aa))
    return out


def _found(seqs: DataFrame, least: int, strands: str, shifts: int) -> DataFrame:
    """(name, strand, shift, beg, end, len, aalen, aa); nothing is shuffled."""
    schema = pa.schema([("strand", pa.string()), *((c, pa.int64()) for c in ("shift", "beg", "end", "len", "aalen")), ("aa", pa.string())])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                at, rows = [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    own = _frames(text or "", least, strands, shifts)
                    at += [i] * len(own)
                    rows += own
                if rows:
                    cols = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int32())), *cols], ["name", *schema.names])

    kind = seqs.schema["name"].dataType.simpleString()
    return seqs.select("name", "seq").mapInArrow(kernel, f"name {kind}, {ORF}")


def frame_zero(seqs: DataFrame, least: int = 25) -> DataFrame:
    """(name, beg, end, aa): stretches in frame 0 with nucleotide coordinates."""
    return _found(seqs, least, "+", 1).select("name", "beg", "end", "aa")


def six_frames(seqs: DataFrame, least: int = 25) -> DataFrame:
    """(name, strand, shift, beg, end, len, aalen, aa) in all six frames; beg > end on the minus strand."""
    return _found(seqs, least, "+-", 3)


def best(orfs: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` longest of each sequence, ties by strand, frame and place."""
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("len"), "strand", "shift", "beg"))
    return orfs.withColumn("rank", rank).where(F.col("rank") <= n)


def at_least(seqs: DataFrame, least: int, above: bool = False) -> DataFrame:
    """(name, orf, aa): the frames of ``least`` amino acids or more (``above``: of more), named by sequence, frame and place.

    Sequences that are null, empty or without such a frame give no row.
    """
    o = six_frames(seqs, least + int(above))
    own = F.concat_ws("|", F.col("beg"), F.col("end"), "strand", F.concat(F.lit("aaLEN"), F.col("aalen")))
    return o.select("name", F.concat_ws("|", F.col("name").cast("string"), F.lit("ORF"), own).alias("orf"), "aa")


def packed_rows(orfs: DataFrame, buffer: int = 50) -> DataFrame:
    """(name, beg, end, line): a greedy layout in which features of a line keep ``buffer`` positions apart.

    A sequence's features are laid out in one task.
    """
    import pandas as pd

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        ends: list[int] = []
        out = []
        for lo, hi, name in sorted((min(b, e), max(b, e), n) for b, e, n in zip(pdf.beg, pdf.end, pdf.name, strict=True)):
            line = next((i for i, x in enumerate(ends) if lo > x + buffer), len(ends))
            ends[line:line + 1] = [hi]
            out.append((name, lo, hi, line))
        return pd.DataFrame(out, columns=["name", "beg", "end", "line"])

    return orfs.select("name", "beg", "end").groupBy("name").applyInPandas(kernel, "name long, beg long, end long, line long")
