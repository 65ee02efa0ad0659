"""Annotations: intervals (chr, id, beg, end[, strand, acc]) painted on axes, projected through maps and grouped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.coordinates import translocated
from seqloom.operators.intervals import containment_join, merged, overlap_join
from seqloom.plans.scan import Scan


def chromosome_numbers(gff: DataFrame, mark: str = "Chr", least: float = 0.7) -> DataFrame:
    """``gff`` with chr, the digits after ``mark`` in ``chrom``; other rows go, and under ``least`` of them left raises."""
    found = gff.withColumn("chr", F.regexp_extract("chrom", rf"^.*{mark}(\d+)", 1))
    share = found.agg(F.avg((F.col("chr") != "").cast("double"))).first()[0]
    if share is not None and share < least:
        raise ValueError(f"only {share:.0%} of the rows name a chromosome by {mark}")
    return found.where("chr <> ''").withColumn("chr", F.col("chr").cast("long"))


def prefiltered(gff: DataFrame, patterns: list[str], most: int = 50_000, without: str = "centromeric_repeat") -> DataFrame:
    """GFF rows whose type holds a pattern, without children, one type and rows over ``most``: with id, len and chr."""
    kept = gff.where((F.col("type") != without) & ~F.col("attributes").contains("Parent") & (F.col("end") - F.col("beg") + 1 <= most))
    kept = kept.where(F.col("type").rlike("|".join(f"(?:{p})" for p in patterns)))
    fields = F.array_join(F.slice(F.split("attributes", ";"), 1, 3), "|")
    return kept.withColumns({"id": F.regexp_replace(fields, "ID=|Name=|Classification=", ""), "len": (F.col("end") - F.col("beg") + 1).cast("long"), "chr": F.regexp_replace("chrom", "Chr", "").try_cast("long")})


def painted(items: DataFrame, keys: list[str], length: Column) -> DataFrame:
    """(keys, pos, id): the axis positions of disjoint items that end within ``length``; an overlap raises.

    A position that one item's end shares with the next one's begin belongs to the former.
    """
    by = Window.partitionBy(*keys).orderBy("beg", "end")
    kept = items.where(F.col("end") <= length).withColumn("__last", F.lag("end").over(by))
    clash = F.when(F.col("beg") < F.col("__last"), F.raise_error(F.concat_ws(" ", F.lit("items overlap at"), F.col("beg").cast("string"))).cast("long"))
    first = F.coalesce(clash, F.greatest("beg", F.coalesce(F.col("__last") + 1, F.col("beg"))))
    return kept.withColumn("__first", first).where(F.col("__first") <= F.col("end")).select(*keys, F.explode(F.sequence("__first", "end")).alias("pos"), "id")


def _mapped(items: DataFrame, aln: DataFrame, bins: int) -> DataFrame:
    """(chr, id[, strand], pan, own): the pan positions under each item of one genome."""
    points = aln.select("chr", F.abs("own").alias("beg"), F.abs("own").alias("end"), "pan", "own")
    found = containment_join(points, items, ["chr"], bins)
    strand = [F.col("strand_b").alias("strand")] if "strand" in items.columns else []
    return found.select("chr", F.col("id_b").alias("id"), *strand, F.col("pan_a").alias("pan"), F.col("own_a").alias("own"))


def gene_blocks(items: DataFrame, aln: DataFrame, acc: int, bins: int = 1 << 12) -> DataFrame:
    """(chr, id, beg, end) on the pan axis of one genome's items; ids in more than one run along the axis are dropped."""
    found = _mapped(items.select("chr", "id", "beg", "end"), aln.where(F.col("acc") == acc), bins)
    found = found.join(translocated(found).select("chr", "id"), ["chr", "id"], "left_anti")
    return found.groupBy("chr", "id").agg(F.min("pan").alias("beg"), F.max("pan").alias("end"))


def stranded_blocks(items: DataFrame, aln: DataFrame, acc: int, bins: int = 1 << 12) -> DataFrame:
    """(chr, id, strand, beg, end): as ``gene_blocks``, strands turned where the genome is inverted; ids on two strands are dropped."""
    found = _mapped(items.select("chr", "id", "strand", "beg", "end"), aln.where(F.col("acc") == acc), bins)
    turned = F.when(F.col("own") > 0, F.col("strand")).when(F.col("strand") == "+", "-").otherwise("+")
    found = found.withColumn("strand", turned)
    split = found.groupBy("chr", "id").agg(F.countDistinct("strand").alias("n")).where("n > 1").select("chr", "id")
    found = found.join(split, ["chr", "id"], "left_anti")
    sides = [found.where(F.col("strand") == s) for s in "+-"]
    moved = translocated(sides[0]).select("chr", "id").unionByName(translocated(sides[1]).select("chr", "id"))
    return found.join(moved, ["chr", "id"], "left_anti").groupBy("chr", "id", "strand").agg(F.min("pan").alias("beg"), F.max("pan").alias("end"))


def grouped(items: DataFrame) -> DataFrame:
    """``items`` (chr, strand, beg, end, ..) with group: those of a chromosome and strand that touch or overlap, numbered over all."""
    own = Scan(items, ["chr", "strand"], ["beg", "end"]).reach("__reach", "end")
    own = own.with_column("__new", F.when(F.col("beg") - 1 <= F.col("__reach"), 0).otherwise(1)).running("__own", "__new", peers=True).table.drop("__reach")
    # One row a chromosome and strand.
    counts = own.groupBy("chr", "strand").agg(F.max("__own").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("chr", F.col("strand") != "+").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("chr", "strand", F.coalesce(before, F.lit(0)).alias("__base"))
    return own.join(base, ["chr", "strand"]).withColumn("group", (F.col("__base") + F.col("__own")).cast("long")).drop("__new", "__own", "__base")


def group_blocks(items: DataFrame) -> DataFrame:
    """(chr, strand, group, beg, end) of ``grouped`` items."""
    return items.groupBy("chr", "strand", "group").agg(F.min("beg").alias("beg"), F.max("end").alias("end"))


def exon_groups(exons: DataFrame, blocks: DataFrame, bins: int = 1 << 12) -> DataFrame:
    """(chr, strand, acc, type, beg, end, id, parent): exons (chr, strand, acc, beg, end) inside one block, and their mRNAs.

    Exons of a genome are numbered along each block; an mRNA spans its genome's exons.
    """
    found = containment_join(exons, blocks.select("chr", "strand", "beg", "end", "group"), ["chr", "strand"], bins)
    found = found.withColumnsRenamed({"acc_a": "acc", "group_b": "group"})
    number = F.row_number().over(Window.partitionBy("chr", "strand", "acc", "group").orderBy("beg_a", "end_a"))
    # A fixed format: chromosome, strand number, group and genome.
    mrna = F.format_string("AT%dSG%d%07d.%s", F.col("chr").cast("long"), F.when(F.col("strand") == "+", 1).otherwise(2), F.col("group"), F.col("acc").cast("string"))
    found = found.withColumns({"parent": mrna, "n": number})
    out = ["chr", "strand", "acc", "type", "beg", "end", "id", "parent"]
    one = found.select("chr", "strand", "acc", F.lit("exon").alias("type"), F.col("beg_a").alias("beg"), F.col("end_a").alias("end"), F.format_string("%s.exon%02d", "parent", "n").alias("id"), "parent")
    all_ = found.groupBy("chr", "strand", "acc", "parent").agg(F.min("beg_a").alias("beg"), F.max("end_a").alias("end"))
    return one.unionByName(all_.select("chr", "strand", "acc", F.lit("mRNA").alias("type"), "beg", "end", F.col("parent").alias("id"), F.lit(None).cast("string").alias("parent")).select(*out))


def split_groups(items: DataFrame, bins: int = 1 << 12) -> DataFrame:
    """(chr, strand, group, part, beg, end): groups (chr, strand, group, acc, beg, end) in which a genome has more than one item, cut into parts; others whole.

    A sweep over where some genome's cover begins and ends: a part begins at the last position before a begin that follows an
    end, and ends where cover last changes within it.  A part of one position joins the next one, and two neighbours
    stay one if the genomes that cover what lies between are half as many as those of the larger of them, or more.
    """
    keys = ["chr", "strand", "group"]
    several = items.groupBy(*keys, "acc").count().where("count > 1").select(*keys).distinct()
    own = items.select(*keys, "acc", "beg", "end").join(several, keys, "left_semi")
    cover = merged(own, [*keys, "acc"], touch=1).select(*keys, "acc", "beg", "end")
    bounds = group_blocks(own).withColumnsRenamed({"beg": "lo", "end": "hi"})
    by = Window.partitionBy(*keys)
    # One row for each position and kind of change; a begin changes the position before it.
    changes = cover.join(bounds, keys).select(*keys, "lo", "hi", F.explode(F.array(F.struct((F.col("beg") - 1).alias("at"), F.lit(0).alias("down")), F.struct(F.col("end").alias("at"), F.lit(1).alias("down")))).alias("x"))
    changes = changes.select(*keys, "lo", "hi", "x.*").where("at >= lo AND at < hi").distinct()
    begins = changes.withColumn("was", F.lag("down").over(by.orderBy("at", "down"))).where("down = 0 AND was = 1").select(*keys, F.col("at").alias("beg"))
    begins = begins.unionByName(bounds.select(*keys, F.col("lo").alias("beg"))).distinct()
    parts = begins.join(bounds, keys).withColumn("next", F.lead("beg").over(by.orderBy("beg"))).withColumn("end", F.coalesce(F.col("next") - 1, "hi"))
    # Where a part may end: at an end of cover, or right after a change.
    stops = changes.select(*keys, F.explode(F.when(F.col("down") == 1, F.array("at", F.col("at") + 1)).otherwise(F.array(F.col("at") + 1))).alias("at")).distinct()
    swept = begins.select(*keys, F.col("beg").alias("at"), F.lit(0).alias("kind")).unionByName(stops.select(*keys, "at", F.lit(1).alias("kind")))
    swept = swept.withColumn("beg", F.last(F.when(F.col("kind") == 0, F.col("at")), ignorenulls=True).over(by.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)))
    fitted = swept.where("kind = 1 AND at > beg").groupBy(*keys, "beg").agg(F.max("at").alias("stop"))
    parts = parts.join(fitted, [*keys, "beg"], "left").withColumn("end", F.when(F.col("next").isNull(), F.col("end")).otherwise(F.coalesce("stop", "beg"))).select(*keys, "beg", "end", F.col("next").isNull().alias("final"))
    # Of parts of one position in a row every other one joins its follower.
    line = by.orderBy("beg")
    one = (F.col("beg") == F.col("end")) & ~F.col("final")
    parts = parts.withColumn("one", one.cast("int")).withColumn("run", F.sum(1 - F.col("one")).over(line))
    number = F.row_number().over(Window.partitionBy(*keys, "run", "one").orderBy("beg"))
    parts = parts.withColumn("gone", (F.col("one") == 1) & (number % 2 == 1))
    parts = parts.withColumn("beg", F.when(F.lag("gone").over(line), F.lag("beg").over(line)).otherwise(F.col("beg"))).where("NOT gone").select(*keys, "beg", "end")
    # How many genomes cover each part and what lies between it and the one before; parts that touch have their two ends between them.
    parts = parts.withColumns({"k": F.row_number().over(line), "back": F.lag("end").over(line)})
    between = parts.where("back IS NOT NULL").select(*keys, "k", F.lit(1).alias("gap"), F.least(F.col("back") + 1, F.col("beg") - 1).alias("beg"), F.greatest(F.col("back") + 1, F.col("beg") - 1).alias("end"))
    asked = parts.select(*keys, "k", F.lit(0).alias("gap"), "beg", "end").unionByName(between)
    held = overlap_join(asked, cover, keys, bins).groupBy(*keys, F.col("k_a").alias("k")).agg(F.countDistinct(F.when(F.col("gap_a") == 0, F.col("acc_b"))).alias("n"), F.countDistinct(F.when(F.col("gap_a") == 1, F.col("acc_b"))).alias("g"))
    parts = parts.join(held, [*keys, "k"], "left").na.fill(0, ["n", "g"])
    apart = F.when(2 * F.col("g") >= F.greatest("n", F.lag("n").over(by.orderBy("k"))), 0).otherwise(1)
    parts = parts.withColumn("part", F.when(F.col("k") == 1, 1).otherwise(apart)).withColumn("part", F.sum("part").over(by.orderBy("k")))
    cut = parts.groupBy(*keys, "part").agg(F.min("beg").alias("beg"), F.max("end").alias("end"))
    whole = group_blocks(items.join(several, keys, "left_anti"))
    return cut.unionByName(whole.select(*keys, F.lit(1).cast("long").alias("part"), "beg", "end"))
