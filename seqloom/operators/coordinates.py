"""Signed coordinate maps (chr, acc, pan, own): own < 0 is the inverted strand, absent positions have no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.intervals import overlap_join
from seqloom.plans.groups import small_or_keyed
from seqloom.plans.scan import Scan

AXIS = ["chr", "acc"]


def ranked(aln: DataFrame) -> DataFrame:
    """``aln`` with rank: the signed ordinal of each own coordinate."""
    n = Scan(aln, AXIS, [F.abs("own")]).number("__n").table
    return n.withColumn("rank", (F.col("__n") * F.signum("own").cast("long")).cast("long")).drop("__n")


def with_blocks(aln: DataFrame) -> DataFrame:
    """``aln`` with rank and block: maximal runs along pan whose signed ranks go up by one, numbered along pan."""
    r = Scan(ranked(aln), AXIS, ["pan"]).before(__was="rank")
    r = r.with_column("__new", F.when(F.col("rank") - F.col("__was") == 1, 0).otherwise(1)).running("block", "__new")
    return r.table.drop("__was", "__new")


def blocks(aln: DataFrame) -> DataFrame:
    """(chr, acc, block, pan_b, pan_e, own_b, own_e, n, dir)"""
    return with_blocks(aln).groupBy(*AXIS, "block").agg(
        F.min("pan").alias("pan_b"), F.max("pan").alias("pan_e"), F.min_by("own", "pan").alias("own_b"), F.max_by("own", "pan").alias("own_e"),
        F.count("*").alias("n"), F.signum(F.min("own")).cast("int").alias("dir"),
    )


def merged_blocks(aln: DataFrame, gap: int = 10_000) -> DataFrame:
    """(chr, acc, pan_b, pan_e, n): neighbouring blocks of one direction as one while both gaps are under ``gap``."""
    b = Scan(blocks(aln), AXIS, ["pan_b"]).before(__dir="dir", __pan="pan_e", __own="own_e")
    close = (F.col("dir") == F.col("__dir")) & (F.col("pan_b") - F.col("__pan") < gap) & (F.abs(F.col("own_b") - F.col("__own")) < gap)
    b = b.with_column("__new", F.when(close, 0).otherwise(1)).running("__g", "__new").table
    return b.groupBy(*AXIS, "__g").agg(F.min("pan_b").alias("pan_b"), F.max("pan_e").alias("pan_e"), F.sum("n").alias("n")).drop("__g")


def within_blocks(items: DataFrame, aln: DataFrame) -> DataFrame:
    """``items`` (chr, acc, beg, end, ..) on the pan axis that begin and end in one block; those with an end outside all blocks go."""
    b = with_blocks(aln).select(*AXIS, F.col("pan").alias("beg"), F.col("block").alias("__block"))
    begun = items.join(b, [*AXIS, "beg"])
    return begun.join(b.withColumnRenamed("beg", "end"), [*AXIS, "end", "__block"], "left_semi").select(*items.columns)


def breaks(aln: DataFrame) -> DataFrame:
    """(chr, acc, idx_beg, idx_end, val_beg, val_end, len_acc, len_comb): neighbours within a block that are not adjacent on both axes."""
    b = Scan(with_blocks(aln), AXIS, ["pan"]).after(idx_end="pan", val_end="own", __block="block").table.where("block = __block")
    own, pan = F.abs(F.col("val_end") - F.col("own")) - 1, F.col("idx_end") - F.col("pan") - 1
    b = b.withColumns({"len_acc": own, "len_comb": pan}).where((F.col("len_acc") != 0) | (F.col("len_comb") != 0))
    return b.select(*AXIS, F.col("pan").alias("idx_beg"), "idx_end", F.col("own").alias("val_beg"), "val_end", "len_acc", "len_comb")


def without_short_blocks(aln: DataFrame, least: int = 100, passes: int = 2) -> DataFrame:
    """``aln`` without the positions of blocks of up to ``least`` in pan span; blocks are found anew in each pass."""
    for _ in range(passes):
        b = with_blocks(aln)
        long = b.groupBy(*AXIS, "block").agg((F.max("pan") - F.min("pan")).alias("__span")).where(F.col("__span") > least)
        aln = b.join(small_or_keyed(long), [*AXIS, "block"], "left_semi").select(*AXIS, "pan", "own")
    return aln


def compacted(aln: DataFrame) -> DataFrame:
    """``aln`` on an axis without positions that no genome holds.

    The ranks come from one row a used position and chromosome; ranges of the axis are counted first,
    so a chromosome's axis is never ordered in one task.
    """
    used = aln.select("chr", "pan").distinct().withColumn("__r", F.floor(F.col("pan") / 65536))
    before = Window.partitionBy("chr").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    base = used.groupBy("chr", "__r").agg(F.count("*").alias("__n")).select("chr", "__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    own = F.row_number().over(Window.partitionBy("chr", "__r").orderBy("pan"))
    new = used.withColumn("__own", own).join(base, ["chr", "__r"]).select("chr", "pan", (F.col("__base") + F.col("__own")).alias("new_pan"))
    return aln.join(new, ["chr", "pan"]).select(*AXIS, F.col("new_pan").alias("pan"), "own")


def pair_map(aln: DataFrame, acc1: int, acc2: int) -> DataFrame:
    """(chr, x, y, block): own coordinates of one genome (made positive) against the other's, with the other's block."""
    a = aln.where(F.col("acc") == acc1).select("chr", "pan", F.col("own").alias("x"))
    b = with_blocks(aln.where(F.col("acc") == acc2)).select("chr", "pan", F.col("own").alias("y"), "block")
    m = a.join(b, ["chr", "pan"])
    s = F.signum("x").cast("long")
    return m.select("chr", F.abs("x").alias("x"), (F.col("y") * s).alias("y"), "block")


def _lifted(found: DataFrame) -> DataFrame:
    ok = found.where((F.signum(F.col("y_b") * F.col("y_e")) == 1) & (F.col("block_b") == F.col("block_e")))
    neg = F.col("y_b") < 0
    ok = ok.withColumns({
        "beg2": F.when(neg, F.abs("y_e")).otherwise(F.col("y_b")), "end2": F.when(neg, F.abs("y_b")).otherwise(F.col("y_e")),
        "strand2": F.when(neg, F.when(F.col("strand") == "+", "-").otherwise("+")).otherwise(F.col("strand")),
    }).where("beg2 <= end2")
    ratio = F.round((F.col("end2") - F.col("beg2") + 1) / (F.col("end") - F.col("beg") + 1), 2)
    return ok.select("chr", "id", "beg", "end", "strand", "beg2", "end2", "strand2", (F.col("end2") - F.col("beg2") + 1).alias("len_new"), ratio.alias("len_ratio"))


def lift(items: DataFrame, aln: DataFrame, acc1: int, acc2: int, exact: bool = True) -> DataFrame:
    """Intervals (chr, id, beg, end, strand) of one genome in another's coordinates.

    Both ends must be mapped (exact), or the next mapped position after the begin and the last one before
    the end are taken; ends in different blocks or directions are lost; inverted
    intervals swap ends and strand.
    """
    m = pair_map(aln, acc1, acc2)
    items = items.where("beg > 0 AND end > 0")
    if exact:
        b = m.select("chr", F.col("x").alias("beg"), F.col("y").alias("y_b"), F.col("block").alias("block_b"))
        e = m.select("chr", F.col("x").alias("end"), F.col("y").alias("y_e"), F.col("block").alias("block_e"))
        return _lifted(items.join(b, ["chr", "beg"]).join(e, ["chr", "end"]))
    packed = F.struct("y", "block")
    marks = m.select("chr", F.col("x").alias("at"), F.lit(1).alias("k"), packed.alias("v"), F.lit(None).cast("long").alias("id"))
    none = F.lit(None).cast("struct<y: bigint, block: bigint>")
    # At one position, a mapped position stands after the begins and before the ends.
    begs = items.select("chr", F.col("beg").alias("at"), F.lit(0).alias("k"), none.alias("v"), "id")
    ends = items.select("chr", F.col("end").alias("at"), F.lit(2).alias("k"), none.alias("v"), "id")
    axis = Scan(marks.unionByName(begs).unionByName(ends), ["chr"], ["at", "k"]).next("nxt", "v").last("prv", "v").table
    b = axis.where("k = 0").select("chr", "id", F.col("nxt.y").alias("y_b"), F.col("nxt.block").alias("block_b"))
    e = axis.where("k = 2").select("chr", "id", F.col("prv.y").alias("y_e"), F.col("prv.block").alias("block_e"))
    return _lifted(items.join(b, ["chr", "id"]).join(e, ["chr", "id"]))


def lift_bed(items: DataFrame, aln: DataFrame, acc1: int, acc2: int, exact: bool = True) -> DataFrame:
    """The same for 0-based half-open intervals."""
    lifted = lift(items.withColumn("beg", F.col("beg") + 1), aln, acc1, acc2, exact)
    return lifted.withColumns({"beg": F.col("beg") - 1, "beg2": F.col("beg2") - 1})


def lift_points(points: DataFrame, aln: DataFrame, acc1: int, acc2: int) -> DataFrame:
    """(chr, id, pos, pos2, strand2) of points (chr, id, pos) that are mapped."""
    items = points.select("chr", "id", F.col("pos").alias("beg"), F.col("pos").alias("end"), F.lit("+").alias("strand"))
    return lift(items, aln, acc1, acc2).select("chr", "id", F.col("beg").alias("pos"), F.col("beg2").alias("pos2"), "strand2")


def region(aln: DataFrame, chr_: int, acc: int, beg: int, end: int) -> DataFrame:
    """All genomes' positions between the pan coordinates of two own coordinates; empty if one is not mapped."""
    own = aln.where((F.col("chr") == chr_) & (F.col("acc") == acc) & F.abs("own").isin(beg, end)).agg(F.min("pan").alias("lo"), F.max("pan").alias("hi"), F.count("*").alias("n"))
    ends = own.first()  # one row
    if ends.n < (1 if beg == end else 2):
        return aln.limit(0)
    return aln.where((F.col("chr") == chr_) & F.col("pan").between(ends.lo, ends.hi))


def concordant(aln: DataFrame, ref0: int, ref1: int) -> DataFrame:
    """(chr, acc, pan, own, trust): a genome's positions on which both references' frames agree, ambiguous ones dropped.

    Frame 1 is frame 0 moved by the references' shared map: a position counts if the
    pan coordinate is held by both references or by the first alone; own coordinates that
    come up twice go.  ``trust`` counts the agreeing references.
    """
    r0 = aln.where(F.col("acc") == ref0).select("chr", "pan", F.col("own").alias("o0"))
    r1 = aln.where(F.col("acc") == ref1).select("chr", "pan", F.col("own").alias("o1"))
    refs = r0.join(r1, ["chr", "pan"], "left")
    a = aln.where(~F.col("acc").isin(ref0, ref1)).join(refs, ["chr", "pan"])
    agree = F.col("o1").isNull() | (F.signum("o0") == F.signum("o1"))
    a = a.where(agree).select(*AXIS, "pan", (F.col("own") * F.signum("o0").cast("long")).alias("own"), F.when(F.col("o1").isNull(), 1).otherwise(2).alias("trust"))
    return a.withColumn("__n", F.count("*").over(Window.partitionBy("chr", "acc", "own"))).where("__n = 1").drop("__n")


def coverage_of(aln: DataFrame) -> DataFrame:
    """(chr, acc, n): positions that each genome holds."""
    return aln.groupBy(*AXIS).agg(F.count("*").alias("n"))


def translocated(items: DataFrame, axis: Column | str = "pan") -> DataFrame:
    """Ids of (chr, pan, id) that come in more than one run along the axis."""
    new = F.when(F.col("id") == F.col("__was"), 0).otherwise(1)
    return Scan(items, ["chr"], [axis]).before(__was="id").table.withColumn("__new", new).groupBy("chr", "id").agg(F.sum("__new").alias("runs")).where("runs > 1")


def to_pan(items: DataFrame, aln: DataFrame, acc: int) -> DataFrame:
    """(chr, id, beg, end, strand) of one genome's intervals on the pan axis; both ends must be mapped.

    Where the genome is inverted ends and strand turn; ends of different directions are lost.
    """
    m = aln.where(F.col("acc") == acc).select("chr", F.abs("own").alias("x"), "pan", F.signum("own").cast("int").alias("d"))
    b = m.select("chr", F.col("x").alias("beg"), F.col("pan").alias("pb"), F.col("d").alias("db"))
    e = m.select("chr", F.col("x").alias("end"), F.col("pan").alias("pe"), F.col("d").alias("de"))
    both = items.join(b, ["chr", "beg"]).join(e, ["chr", "end"]).where("db = de")
    turned = F.when(F.col("db") > 0, F.col("strand")).when(F.col("strand") == "+", "-").otherwise("+")
    return both.select("chr", "id", F.least("pb", "pe").alias("beg"), F.greatest("pb", "pe").alias("end"), turned.alias("strand"))


def sampled(aln: DataFrame, acc: int, step: int = 10_000) -> DataFrame:
    """(chr, pan, own): every ``step``-th pan position from the first on that a genome holds."""
    return aln.where((F.col("acc") == acc) & ((F.col("pan") - 1) % step == 0)).select("chr", "pan", "own")


def break_kinds(found: DataFrame, short: int = 50, large: int = 15_000) -> DataFrame:
    """``found`` (single, idx_beg, idx_end, len_acc, len_mean) with kind: singleton, short, large or extra; others have none."""
    one, inner = F.col("single") == 1, F.col("idx_end") - F.col("idx_beg") - 1
    kind = F.when(one & (inner == 0), "singleton").when(~one & (F.col("len_mean") > large), "extra").when(~one & (F.col("len_acc") <= short), "short").when(~one & (F.col("len_acc") > short), "large")
    return found.withColumn("kind", kind)


def directed(found: DataFrame) -> DataFrame:
    """Blocks (pan_b, pan_e, own_b, own_e, dir) with both pairs of ends swapped where ``dir`` is 1."""
    back = F.col("dir") == 1
    pick = lambda a, b: F.when(back, F.col(b)).otherwise(F.col(a))
    return found.withColumns({"pan_b": pick("pan_b", "pan_e"), "pan_e": pick("pan_e", "pan_b"), "own_b": pick("own_b", "own_e"), "own_e": pick("own_e", "own_b")})


def split_edges(found: DataFrame, n: int = 5) -> DataFrame:
    """Blocks cut into ``n`` parts of equal share on both axes, as (.., part, pan_b, pan_e, own_b, own_e) by linear interpolation."""
    at = found.withColumn("part", F.explode(F.sequence(F.lit(1), F.lit(n))))
    on = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / n
    lo, hi = F.col("part") - 1, F.col("part")
    return at.withColumns({"pan_b": on("pan_b", "pan_e", lo), "pan_e": on("pan_b", "pan_e", hi), "own_b": on("own_b", "own_e", lo), "own_e": on("own_b", "own_e", hi)})


def split_turns(found: DataFrame, n: int = 5) -> DataFrame:
    """``split_edges`` of the blocks whose direction differs from that of the block before them on a genome's axis; others stay whole as part 1."""
    marked = Scan(found, AXIS, ["pan_b"]).before(__was="dir").table
    marked = marked.withColumn("__turn", F.coalesce(F.col("dir") != F.col("__was"), F.lit(False))).drop("__was")
    whole = marked.where("NOT __turn").withColumn("part", F.lit(1))
    cols = ["pan_b", "pan_e", "own_b", "own_e"]
    whole = whole.withColumns({c: F.col(c).cast("double") for c in cols})
    return split_edges(marked.where("__turn"), n).unionByName(whole).drop("__turn")


def fragments(bases: DataFrame, wanted: DataFrame, bins: int = 1 << 12) -> DataFrame:
    """(id, acc, pan_beg, pan_end, seq): every genome's aligned bases in regions (id, chr, acc, beg, end) of one genome's own coordinates.

    ``bases`` is (chr, acc, pan, own, nt).  A column without a base is ``-``; a genome of the chromosome without any has gaps
    alone.  Regions with an end that is not mapped are left out.  A region's row of one genome is one string.
    """
    at = lambda end: bases.select("chr", "acc", F.abs("own").alias(end), F.col("pan").alias(f"__{end}"))
    ends = wanted.join(at("beg"), ["chr", "acc", "beg"]).join(at("end"), ["chr", "acc", "end"])
    spans = ends.select("id", "chr", F.least("__beg", "__end").alias("beg"), F.greatest("__beg", "__end").alias("end"))
    points = bases.select("chr", "acc", F.col("pan").alias("beg"), F.col("pan").alias("end"), "nt")
    inside = overlap_join(points, spans, ["chr"], bins).select(F.col("id_b").alias("id"), F.col("acc_a").alias("acc"), F.col("beg_a").alias("pan"), F.col("nt_a").alias("nt"), F.col("beg_b").alias("lo"))
    before = F.coalesce(F.lag("pan").over(Window.partitionBy("id", "acc").orderBy("pan")), F.col("lo") - 1)
    piece = F.concat(F.repeat(F.lit("-"), (F.col("pan") - before - 1).cast("int")), "nt")
    held = inside.withColumn("piece", piece).groupBy("id", "acc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pan", "piece"))), lambda x: x["piece"]), "").alias("seq"))
    genomes = bases.groupBy("chr").agg(F.collect_set("acc").alias("accs"))  # one row a chromosome
    every = spans.join(genomes, "chr").select("id", "beg", "end", F.explode("accs").alias("acc"))
    out = every.join(held, ["id", "acc"], "left")
    return out.select("id", "acc", F.col("beg").alias("pan_beg"), F.col("end").alias("pan_end"), F.rpad(F.coalesce("seq", F.lit("")), (F.col("end") - F.col("beg") + 1).cast("int"), F.lit("-")).alias("seq"))
