"""Alignments: string rows (aln, row, seq) of equal length within an alignment, or cells (aln, row, col, nt)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.plans.groups import gathered, pair_blocks, sorted_groups

NUCLEOTIDES = ("A", "C", "G", "T")
GAP = "-"


def check_equal_lengths(rows: DataFrame) -> DataFrame:
    """Alignments (aln) whose rows differ in length; empty for a valid table."""
    return rows.groupBy("aln").agg(F.countDistinct(F.length("seq")).alias("n")).where("n > 1").select("aln")


def to_cells(rows: DataFrame) -> DataFrame:
    """One row for each cell; columns count from 1."""
    cells = rows.select("aln", "row", F.posexplode(F.split("seq", "")).alias("col", "nt")).where("nt <> ''")
    return cells.select("aln", "row", (F.col("col") + 1).cast("long").alias("col"), "nt")


#: Bits of a code point.
SYMBOL = 21


def to_strings(cells: DataFrame, gaps: bool = True) -> DataFrame:
    """Cells of one symbol or none back to strings; without gaps, an all-gap row becomes an empty string.

    A cell travels as one number, its column above the code point of its symbol: a struct would take five times the bytes.
    """
    one = F.when(F.length("nt") <= 1, F.nullif("nt", F.lit(""))).otherwise(F.raise_error(F.lit("a cell holds one symbol")).cast("string"))
    packed = F.coalesce(F.col("col"), F.lit(-1)).cast("long") * (1 << SYMBOL) + F.ascii(F.when(F.col("nt").isNotNull(), one))

    def symbol(cell: Column) -> Column:
        code = cell.bitwiseAND(F.lit((1 << SYMBOL) - 1))
        return F.when(code < 128, F.char(code)).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    seq = F.array_join(F.transform(F.array_sort(F.collect_list(packed)), symbol), "")
    return cells.groupBy("aln", "row").agg((seq if gaps else F.replace(seq, F.lit(GAP), F.lit(""))).alias("seq"))


def ungapped(rows: DataFrame) -> DataFrame:
    """The same from strings, without exploding them."""
    return rows.select("aln", "row", F.replace("seq", F.lit(GAP), F.lit("")).alias("seq"))


def positions_of_cells(cells: DataFrame, flank: int = 0) -> DataFrame:
    """(aln, row, col, pos): the ungapped position of each cell, 0 at gaps and in ``flank`` symbols at each end."""
    here = (F.col("nt") != GAP).cast("int")
    by = Window.partitionBy("aln", "row")
    n = F.sum(here).over(by.orderBy("col").rowsBetween(Window.unboundedPreceding, 0))
    inside = (here == 1) & (n > flank) & (n <= F.sum(here).over(by) - flank)
    return cells.select("aln", "row", "col", F.when(inside, n - flank).otherwise(0).cast("long").alias("pos"))


def positions(rows: DataFrame, flank: int = 0) -> DataFrame:
    """(aln, row, pos): the same as one array a row; a row never leaves its task."""
    found = codes.of_text("array<int>", pa.list_(pa.int32()), lambda text: codes.running(text, flank))
    return rows.select("aln", "row", found(F.col("seq")).alias("pos"))


#: Columns of an alignment that one count array holds.
BLOCK = 1 << 14
_CASES = [[ord(x), ord(x.lower())] for x in NUCLEOTIDES] + [[ord(GAP)]]


def _counted(rows: list[str], lo: int, block: int) -> np.ndarray:
    """Counts of A, C, G, T, gap and rows in each column from ``lo`` on, of up to ``block`` columns."""
    parts = [codes.symbols(r[lo : lo + block]) for r in rows]
    out = np.zeros((6, max(map(len, parts))), dtype=np.int64)
    if len({len(x) for x in parts}) == 1:
        mx = np.vstack(parts)
        for k, cases in enumerate(_CASES):
            out[k] = sum((mx == c).sum(axis=0) for c in cases)
        out[5] = len(mx)
    else:
        for x in parts:
            for k, cases in enumerate(_CASES):
                out[k, : len(x)] += np.isin(x, cases)
            out[5, : len(x)] += 1
    return out


def column_counts(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(aln, col, a, c, g, t, gap, n): symbol counts of each column of string rows, case ignored.

    Rows of one alignment in a batch become one array of counts for each block of columns, so what is shuffled
    is a few numbers a column and batch; arrays of a block are added up by one task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).dictionary_encode()
            which, seqs = code.indices.to_numpy(), batch.column(1).to_pylist()
            order = np.argsort(which, kind="stable")
            at = np.flatnonzero(np.diff(which[order], prepend=-1))
            out: tuple[list, list, list] = ([], [], [])
            for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(order)], strict=True):
                own = [s for i in order[lo:hi].tolist() if (s := seqs[i])]
                for b in range(0, max(map(len, own), default=0), block):
                    held = [s for s in own if len(s) > b]
                    out[0].append(int(which[order[lo]]))
                    out[1].append(b // block)
                    out[2].append(_counted(held, b, block).tobytes())
            if out[0]:
                yield pa.RecordBatch.from_arrays([code.dictionary.take(pa.array(out[0], pa.int32())), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["aln", "block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 2):
            parts = [np.frombuffer(x, np.int64).reshape(6, -1) for x in group.column(2).to_pylist()]
            total = np.zeros((6, max(p.shape[1] for p in parts)), dtype=np.int64)
            for p in parts:
                total[:, : p.shape[1]] += p
            col = group.column(1)[0].as_py() * block + 1 + np.arange(total.shape[1])
            key = pa.array([group.column(0)[0].as_py()] * len(col), group.column(0).type)
            yield pa.RecordBatch.from_arrays([key, pa.array(col), *map(pa.array, total)], ["aln", "col", "a", "c", "g", "t", "gap", "n"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(add(batches))

    kind = rows.schema["aln"].dataType.simpleString()
    held = rows.select("aln", "seq").mapInArrow(count, f"aln {kind}, block long, counts binary")
    held = held.repartition("aln", "block").sortWithinPartitions("aln", "block")
    return held.mapInArrow(added, f"aln {kind}, col long, a long, c long, g long, t long, gap long, n long")


def profile(rows: DataFrame, gaps: bool = True) -> DataFrame:
    """(aln, col, a, c, g, t[, gap]): symbol counts of each column, case ignored."""
    return column_counts(rows).select("aln", "col", "a", "c", "g", "t", *(["gap"] if gaps else []))


def profile_of_cells(cells: DataFrame, gaps: bool = True) -> DataFrame:
    """The same from one row a cell."""
    nt = F.upper("nt")
    sums = [F.sum((nt == x).cast("long")).alias(x.lower()) for x in NUCLEOTIDES]
    return cells.groupBy("aln", "col").agg(*sums, *([F.sum((nt == GAP).cast("long")).alias("gap")] if gaps else []))


def _marked(rows: DataFrame, mark: Column) -> DataFrame:
    """``rows`` beside ``marks``: a 1 for each column of their alignment where ``mark`` of its counts holds, else 0."""
    marks = column_counts(rows).withColumn("block", F.floor((F.col("col") - 1) / BLOCK)).withColumn("m", F.when(mark, F.lit("1")).otherwise(F.lit("0")))
    by_order = lambda names: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*names))), lambda x: x[names[1]]), "")
    marks = marks.groupBy("aln", "block").agg(by_order(["col", "m"]).alias("m")).groupBy("aln").agg(by_order(["block", "m"]).alias("marks"))
    return rows.join(marks, "aln")


def _first_best(counts: list[tuple[str, Column]], none: str | None) -> Column:
    most = F.greatest(*[c for _, c in counts])
    out = F.lit(counts[-1][0])
    for name, c in reversed(counts[:-1]):
        out = F.when(c == most, F.lit(name)).otherwise(out)
    return out if none is None else F.when(most == 0, F.lit(none)).otherwise(out)


def consensus(rows: DataFrame, empty: str | None = None) -> DataFrame:
    """(aln, col, nt) of string rows: the most frequent nucleotide, ties to the first in A, C, G, T.

    A column of gaps becomes ``A`` as the first candidate, or ``empty`` if that is given.
    """
    best = _first_best([(x, F.col(x.lower())) for x in NUCLEOTIDES], empty)
    return profile(rows).select("aln", "col", best.alias("nt"))


def consensus_rows(rows: DataFrame, amount: int) -> DataFrame:
    """(aln, row, seq): ``amount`` consensus rows; row i has a symbol where round(non-gaps / rows * amount) >= i."""
    p = profile(rows)
    filled = F.col("a") + F.col("c") + F.col("g") + F.col("t")
    level = F.bround(filled / (filled + F.col("gap")) * amount, 0)
    best = _first_best([(x, F.col(x.lower())) for x in NUCLEOTIDES], None)
    out = p.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(amount).cast("long"))))
    return to_strings(out.select("aln", "row", "col", F.when(level >= F.col("row"), best).otherwise(F.lit(GAP)).alias("nt")))


def frequent_columns(rows: DataFrame, least: int = 3) -> DataFrame:
    """(aln, row, seq) of the columns with ``least`` or more symbols; rows always stay."""
    kept = codes.of_texts("string", pa.string(), codes.chosen)
    return _marked(rows, F.col("n") - F.col("gap") >= least).select("aln", "row", kept(F.col("seq"), F.col("marks")).alias("seq"))


def conserved_span(rows: DataFrame, presence: int = 3, same: float = 0.9, stretch: int = 5) -> DataFrame:
    """(aln, first, last): the columns between the outermost runs of ``stretch`` or more conserved ones."""
    p = profile(rows)
    most, filled = F.greatest("a", "c", "g", "t"), F.col("a") + F.col("c") + F.col("g") + F.col("t")
    fit = p.where((most >= presence) & (most / F.greatest(filled, F.lit(1)) >= same)).select("aln", "col")
    island = F.col("col") - F.row_number().over(Window.partitionBy("aln").orderBy("col"))
    runs = fit.withColumn("i", island).groupBy("aln", "i").agg(F.min("col").alias("b"), F.max("col").alias("e"))
    return runs.where(F.col("e") - F.col("b") + 1 >= stretch).groupBy("aln").agg(F.min("b").alias("first"), F.max("e").alias("last"))


def difference(rows: DataFrame, reference: int = 0) -> DataFrame:
    """(aln, row, diff): per column ``g`` gap, ``s`` same as the reference row (or a gap there), ``d`` different."""
    ref = rows.where(F.col("row") == reference).select("aln", F.col("seq").alias("r"))
    mark = lambda a, b: F.when(a == GAP, F.lit("g")).when((b == GAP) | (a == b), F.lit("s")).otherwise(F.lit("d"))
    diff = F.array_join(F.zip_with(F.split("seq", ""), F.split("r", ""), mark), "")
    return rows.join(ref, "aln").select("aln", "row", diff.alias("diff"))


def pair_counts(rows: DataFrame, size: int = 256) -> DataFrame:
    """(aln, i, j, same, both, either, n_i, n_j) for each pair i < j: equal symbols, columns where both or either have one.

    Rows meet in pairs of blocks of ``size``; there all pairs follow from products of indicator matrices.
    """
    kind = rows.schema["aln"].dataType.simpleString()
    names = ["aln", "i", "j", "same", "both", "either", "n_i", "n_j"]

    def compared(x: list[np.ndarray], y: list[np.ndarray], chunk: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
        same, both = (np.zeros((len(x), len(y)), dtype=np.int64) for _ in range(2))
        for lo in range(0, len(x[0]), chunk):
            a, b = (np.vstack([r[lo : lo + chunk] for r in side]) for side in (x, y))
            both += ((a != codes.GAP).astype(np.float32) @ (b != codes.GAP).astype(np.float32).T).astype(np.int64)
            for s in np.intersect1d(a, b).tolist():
                if s != codes.GAP:
                    same += ((a == s).astype(np.float32) @ (b == s).astype(np.float32).T).astype(np.int64)
        return same, both

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            lo, hi, own, row = (group.column(k).to_numpy() for k in (1, 2, 3, 4))
            seqs = [codes.symbols(t) for t in group.column(5).to_pylist()]
            left, right = np.flatnonzero(own == lo[0]), np.flatnonzero(own == hi[0])
            if not len(left) or not len(right):
                continue
            same, both = compared([seqs[i] for i in left], [seqs[i] for i in right])
            full = np.array([int((s != codes.GAP).sum()) for s in seqs])
            p, q = np.nonzero((row[left][:, None] < row[right][None, :]) | (lo[0] != hi[0]))
            a, b, k, m = left[p], right[q], same[p, q], both[p, q]
            a, b = np.where(row[a] < row[b], a, b), np.where(row[a] < row[b], b, a)
            cols = [row[a], row[b], k, m, full[a] + full[b] - m, full[a], full[b]]
            yield pa.RecordBatch.from_arrays([pa.array([group.column(0)[0].as_py()] * len(a), group.column(0).type), *(pa.array(c.astype(np.int64)) for c in cols)], names)

    dealt = pair_blocks(rows.select("aln", F.col("row").cast("long").alias("row"), "seq"), "aln", "row", size)
    dealt = dealt.select("aln", "lo", "hi", "own", "row", "seq").repartition("aln", "lo", "hi").sortWithinPartitions("aln", "lo", "hi")
    return dealt.mapInArrow(kernel, f"aln {kind}, " + ", ".join(f"{n} long" for n in names[1:]))


def distances(rows: DataFrame) -> DataFrame:
    """(aln, i, j, shared, p, union_): 1 - equal / shorter length; differing / jointly present (null if none); mismatches / union."""
    c = pair_counts(rows)
    share = lambda a, b: F.round(a / F.nullif(b, F.lit(0)), 9)
    return c.select("aln", "i", "j", (1 - share(F.col("same"), F.least("n_i", "n_j"))).alias("shared"), share(F.col("both") - F.col("same"), F.col("both")).alias("p"), share(F.col("either") - F.col("same"), F.col("either")).alias("union_"))


def bad_alignments(rows: DataFrame, cutoff: float = 0.2, shortest: int = 0) -> DataFrame:
    """(aln, bad): whether a gap-free run of some row has over ``cutoff`` of its columns with other than one kind of nucleotide.

    Alignments of fewer than ``shortest`` columns are never bad; those without any nucleotide have no row.
    """
    kinds = sum(((F.col(x.lower()) > 0).cast("int") for x in NUCLEOTIDES[1:]), (F.col("a") > 0).cast("int"))
    share = F.arrow_udf(codes.differing_shares, "double")
    found = _marked(rows, kinds != 1).select("aln", F.length("seq").alias("width"), share(F.col("seq"), F.col("marks")).alias("share"))
    return found.where("share is not null").groupBy("aln").agg(((F.max("share") > cutoff) & (F.max("width") >= shortest)).alias("bad"))
