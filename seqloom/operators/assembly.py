"""The final axis of an alignment: breaks of the skeleton make room for the alignments of their loci.

A map is long and sparse, (chr, acc, pan, own): a genome that is absent in a column has no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.intervals import overlap_join


def room(breaks: DataFrame) -> DataFrame:
    """``breaks`` (chr, id, beg, end, width) with fails, shift and new_beg: what lies strictly between beg and end becomes ``width`` columns.

    A break fails if it has no columns or fewer than it has on the old axis; then its columns stay as many and empty.
    ``shift`` is how many columns the breaks before it add.
    """
    own = F.col("end") - F.col("beg") - 1
    before = Window.partitionBy("chr").orderBy("beg", "end", "id").rowsBetween(Window.unboundedPreceding, -1)
    gain = breaks.withColumn("fails", (F.coalesce("width", F.lit(0)) == 0) | (F.col("width") < own)).withColumn("gain", F.when(F.col("fails"), 0).otherwise(F.col("width") - own))
    # One row a break.
    gain = gain.withColumn("shift", F.coalesce(F.sum("gain").over(before), F.lit(0)).cast("long"))
    return gain.withColumn("new_beg", F.col("beg") + F.col("shift") + 1)


def stretches(placed: DataFrame, last: DataFrame) -> DataFrame:
    """(chr, beg, end, shift): the parts of the old axis that stay, from the end of a break to the begin of the next one; ``last`` is (chr, top)."""
    by = Window.partitionBy("chr").orderBy("beg", "end", "id")
    parts = placed.select("chr", F.coalesce(F.lag("end").over(by), F.lit(1)).alias("from"), F.col("beg").alias("to"), "shift", F.lead("beg").over(by).isNull().alias("final"), "end", "gain")
    tail = parts.where("final").join(last, "chr").select("chr", F.col("end").alias("from"), F.col("top").alias("to"), (F.col("shift") + F.col("gain")).alias("shift"))
    free = last.join(placed.select("chr").distinct(), "chr", "left_anti").select("chr", F.lit(1).alias("from"), F.col("top").alias("to"), F.lit(0).alias("shift"))
    kept = parts.select("chr", "from", "to", "shift").unionByName(tail).unionByName(free)
    return kept.where("from <= to").select("chr", F.col("from").cast("long").alias("beg"), F.col("to").cast("long").alias("end"), F.col("shift").cast("long").alias("shift"))


def assembled(base: DataFrame, breaks: DataFrame, loci: DataFrame, doubles: str = "raise", bins: int = 1 << 12) -> DataFrame:
    """(chr, acc, pan, own) on the axis with the loci: ``base`` (chr, acc, pan, own), ``breaks`` (chr, id, beg, end, width), ``loci`` (chr, id, acc, col, own).

    Positions of the base inside a break go; columns of a locus count from 1.  Loci without a break, of breaks that
    fail, and columns beyond the width are left out, as are zeros.  A position of a genome must come once, whatever
    its sign: otherwise ``raise`` fails, and ``zero`` takes it out of the loci where it comes again, and of
    all of them if the base has it.  Breaks of a chromosome must not overlap, but may share an end.
    """
    placed = room(breaks)
    last = base.groupBy("chr").agg(F.max("pan").alias("top"))
    points = base.where("own <> 0").select("chr", "acc", F.col("pan").alias("beg"), F.col("pan").alias("end"), "own")
    kept = overlap_join(points, stretches(placed, last), ["chr"], bins)
    kept = kept.select("chr", F.col("acc_a").alias("acc"), (F.col("beg_a") + F.col("shift_b")).alias("pan"), F.col("own_a").alias("own"), F.lit(0).alias("locus"))
    added = loci.where("own <> 0").join(placed.where("NOT fails").select("chr", "id", "width", "new_beg"), ["chr", "id"]).where("col BETWEEN 1 AND width")
    added = added.select("chr", "acc", (F.col("new_beg") + F.col("col") - 1).cast("long").alias("pan"), "own", F.lit(1).alias("locus"))
    both = kept.unionByName(added)
    same = Window.partitionBy("chr", "acc", F.abs("own"))
    if doubles == "zero":
        first = F.row_number().over(same.orderBy("locus", "pan", "own"))
        return both.withColumn("__k", first).where("__k = 1 OR locus = 0").select("chr", "acc", "pan", "own")
    if doubles != "raise":
        raise ValueError("doubles is raise or zero")
    once = F.when(F.count("*").over(same) > 1, F.raise_error(F.format_string("position %d of genome %s comes twice", F.abs("own"), F.col("acc").cast("string"))).cast("long")).otherwise(F.col("own"))
    return both.withColumn("own", once).select("chr", "acc", "pan", "own")


def coverage(whole: DataFrame) -> DataFrame:
    """(chr, acc, coverage): how many columns each genome has."""
    return whole.groupBy("chr", "acc").agg(F.count("*").alias("coverage"))


def genome_lines(loci: DataFrame, genomes: DataFrame) -> DataFrame:
    """(genome, locus, seq) for all loci from 1 to the last: an absent genome has gaps of the locus's width, a locus without any row the empty text.

    ``loci`` is (locus, genome, seq) with rows of one width a locus (the first by genome gives it); a genome's repeated rows count once, the first by text.
    """
    top = loci.agg(F.max("locus")).first()[0]
    width = loci.groupBy("locus").agg(F.min(F.struct("genome", F.length("seq").alias("n"))).getField("n").alias("n"))
    rows = loci.groupBy("locus", "genome").agg(F.min("seq").alias("seq"))
    wanted = genomes.select("genome").distinct().select("genome", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(top or 0).cast("long")) if top else F.array().cast("array<bigint>")).alias("locus"))
    found = wanted.join(width, "locus", "left").join(rows, ["locus", "genome"], "left")
    return found.select("genome", "locus", F.coalesce("seq", F.repeat(F.lit("-"), F.col("n").cast("int")), F.lit("")).alias("seq"))


def inserted_back(clean: DataFrame, final: DataFrame, ref: int) -> DataFrame:
    """``final`` (chr, acc, pan, own) with positions of the earlier map ``clean`` that it has lost, where the reference's own position stands.

    A position of another genome comes back if ``final`` has it nowhere, its column in ``clean`` holds a position of ``ref`` and
    ``final`` still has that one; it goes to that one's column.  A column that is taken, or asked for twice, raises.
    """
    mine = lambda df, n: df.where((F.col("acc") == ref) & (F.col("own") != 0)).select("chr", F.col("pan").alias(n), F.col("own").alias("at"))
    others = clean.where((F.col("acc") != ref) & (F.col("own") != 0))
    lost = others.join(final.where("own <> 0").select("chr", "acc", "own"), ["chr", "acc", "own"], "left_anti")
    back = lost.join(mine(clean, "pan"), ["chr", "pan"]).drop("pan").join(mine(final, "pan"), ["chr", "at"]).select("chr", "acc", "pan", "own")
    whole = final.where("own <> 0").select("chr", "acc", "pan", "own").unionByName(back)
    taken = F.count("*").over(Window.partitionBy("chr", "acc", "pan")) > 1
    once = F.when(taken, F.raise_error(F.format_string("column %d of genome %s is taken", "pan", F.col("acc").cast("string"))).cast("long")).otherwise(F.col("own"))
    return whole.withColumn("own", once)
