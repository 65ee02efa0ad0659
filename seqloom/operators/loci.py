"""Alignments of loci of very different size: dealt by their estimated cost, with what cannot be aligned set aside as rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.kernels import star_once
from seqloom.plans.dealing import by_cost
from seqloom.plans.groups import small_or_keyed, sorted_groups


def costs(rows: DataFrame) -> DataFrame:
    """(id, cells, longest) of loci (id, seq): cells of the tables that a star alignment fills, at most, and the longest sequence.

    A sequence that a locus holds several times is aligned once and counts once; null and empty ones cost nothing.
    """
    distinct = rows.select("id", F.xxhash64("seq").alias("h"), F.coalesce(F.length("seq"), F.lit(0)).cast("long").alias("n")).distinct()
    return distinct.groupBy("id").agg((F.sum("n") * F.max("n")).alias("cells"), F.max("n").alias("longest"))


def mixed_rows(rows: list[str], cutoff: float) -> bool:
    """Whether a gap-free run of some row has over ``cutoff`` of its columns with other than one kind of nucleotide."""
    if not rows or not rows[0]:
        return False
    mx = np.array([np.frombuffer(r.encode("ascii", "replace"), np.uint8) for r in rows])
    mixed = sum((mx == ord(x)).any(axis=0).astype(int) for x in "ACGT") != 1
    before = np.concatenate(([0], np.cumsum(mixed)))
    for r in mx:
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (r != ord("-")).astype(int), [0]))))
        begin, end = edges[::2], edges[1::2]
        if ((before[end] - before[begin]) > cutoff * (end - begin)).any():
            return True
    return False


def aligned_loci(rows: DataFrame, tasks: int, longest: int | None = None, cutoff: float = 0.2) -> DataFrame:
    """(id, row, aligned, status): star alignments of the loci (id, row, seq), each row once, in ``tasks`` tasks of about equal cost.

    Status is ``ok``, or tells why ``aligned`` is the sequence as it came: ``bad`` (a gap-free run of some row has over
    ``cutoff`` of its columns mixed), ``failed`` (no memory), ``unnamed`` (a null id).  Sequences of any length are aligned: beyond
    ``kernels.CELLS`` cells a table is kept in part.  Only where a caller gives ``longest`` are loci with a longer sequence left as they came, as ``long``.
    Null and empty sequences become gaps.  A locus is solved in one task, and one is held at a time; repeated rows are aligned alike.
    """
    found = costs(rows.where("id IS NOT NULL"))
    dealt = by_cost(found, "cells", tasks, ["id"]).select("id", "task", (F.lit(False) if longest is None else F.col("longest") > longest).alias("__long"))
    named = rows.select("id", "row", F.coalesce("seq", F.lit("")).alias("seq")).join(small_or_keyed(dealt), "id", "left")
    aside = named.where("id IS NULL OR __long")
    aside = aside.select("id", "row", F.col("seq").alias("aligned"), F.when(F.col("id").isNull(), "unnamed").otherwise("long").alias("status"))
    work = named.where("id IS NOT NULL AND NOT __long").repartitionById(tasks, F.col("task")).select("id", "row", "seq").sortWithinPartitions("id", "row", "seq")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for locus in sorted_groups(batches):
            seqs = locus.column("seq").to_pylist()
            try:
                out = list(star_once(*seqs)) if any(seqs) else seqs
                status = "bad" if mixed_rows(out, cutoff) else "ok"
            except (MemoryError, ValueError):
                out, status = seqs, "failed"
            out = out if status == "ok" else seqs
            yield from pa.table({"id": locus.column("id"), "row": locus.column("row"), "aligned": out, "status": [status] * len(out)}).to_batches()

    kinds = dict(rows.dtypes)
    return work.mapInArrow(kernel, f"id {kinds['id']}, row {kinds['row']}, aligned string, status string").unionByName(aside)
