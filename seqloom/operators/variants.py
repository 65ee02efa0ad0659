"""SNPs and structural variants from coordinate maps and aligned bases (chr, acc, pan, own, nt)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.coordinates import ranked
from seqloom.plans.scan import Scan

NT = ("A", "C", "G", "T")


def consensus(bases: DataFrame, genomes: int) -> DataFrame:
    """(chr, pan, a, c, g, t, gap, nt): counts over genomes and the most frequent base, ties to the first, N without any."""
    sums = [F.sum((F.col("nt") == x).cast("long")).alias(x.lower()) for x in NT]
    p = bases.groupBy("chr", "pan").agg(*sums).withColumn("gap", genomes - (F.col("a") + F.col("c") + F.col("g") + F.col("t")))
    most = F.greatest("a", "c", "g", "t")
    best = F.when(most == 0, "N")
    for x in NT:
        best = best.when(F.col(x.lower()) == most, x)
    return p.withColumn("nt", best)


def snp_positions(bases: DataFrame) -> DataFrame:
    """(chr, pan): positions where some genome's base is not the consensus, from one aggregation."""
    return bases.groupBy("chr", "pan").agg(F.count_distinct("nt").alias("n")).where("n > 1").select("chr", "pan")


def snp_matrix(bases: DataFrame, genomes: list[int]) -> DataFrame:
    """(chr, pan, acc, state): 1 differs from the consensus, 0 equals it, -1 gap, at SNP positions."""
    snps = snp_positions(bases)
    here = bases.join(snps, ["chr", "pan"], "left_semi")
    cons = consensus(here, len(genomes)).select("chr", "pan", F.col("nt").alias("ref"))
    grid = cons.withColumn("acc", F.explode(F.array(*[F.lit(g).cast("long") for g in genomes])))
    joined = grid.join(here.select("chr", "acc", "pan", "nt"), ["chr", "pan", "acc"], "left")
    return joined.select("chr", "pan", "acc", F.when(F.col("nt").isNull(), -1).when(F.col("nt") != F.col("ref"), 1).otherwise(0).alias("state"))


def vcf(bases: DataFrame, genomes: list[int]) -> DataFrame:
    """(chrom, pos, ref, alt, gts): SNP rows; REF is the first genome's base, or the most frequent one where that is a gap.

    ALT lists the other bases in the order of genomes; a genotype is n/n, or ./. for a gap.
    """
    here = bases.join(snp_positions(bases), ["chr", "pan"], "left_semi")
    by = here.groupBy("chr", "pan").agg(F.array_sort(F.collect_list(F.struct("acc", "nt"))).alias("own"), *[F.sum((F.col("nt") == x).cast("int")).alias(x.lower()) for x in NT])
    first = F.try_element_at(F.filter("own", lambda x: x["acc"] == min(genomes)), F.lit(1))["nt"]
    most = F.greatest("a", "c", "g", "t")
    common = F.when(F.col("a") == most, "A").when(F.col("c") == most, "C").when(F.col("g") == most, "G").otherwise("T")
    by = by.withColumn("ref", F.coalesce(first, common))
    by = by.withColumn("alts", F.array_distinct(F.filter(F.transform("own", lambda x: x["nt"]), lambda n: n != F.col("ref"))))
    held = F.map_from_arrays(F.transform("own", lambda x: x["acc"]), F.transform("own", lambda x: x["nt"]))
    by = by.withColumn("held", held)

    def genotype(g: int):
        nt = F.try_element_at("held", F.lit(g).cast("long"))
        k = F.when(nt == F.col("ref"), 0).otherwise(F.array_position("alts", nt))
        return F.when(nt.isNull(), "./.").otherwise(F.concat_ws("/", k.cast("string"), k.cast("string")))

    return by.select(F.col("chr").cast("string").alias("chrom"), F.col("pan").alias("pos"), "ref", F.array_join("alts", ",").alias("alt"), F.array_join(F.array(*[genotype(g) for g in genomes]), "\t").alias("gts"))


def site_pi(bases: DataFrame) -> DataFrame:
    """(chr, pan, pi): 1 - sum n_a (n_a - 1) / (n (n - 1)) over allele copies, two a genome."""
    n = bases.groupBy("chr", "pan", "nt").agg((2 * F.count("*")).alias("k"))
    s = n.groupBy("chr", "pan").agg(F.sum(F.col("k") * (F.col("k") - 1)).alias("same"), F.sum("k").alias("n"))
    return s.select("chr", "pan", F.round(1 - F.col("same") / (F.col("n") * (F.col("n") - 1)), 9).alias("pi"))


def snp_distance(bases: DataFrame) -> DataFrame:
    """(i, j, d, n): differing and shared SNP positions of each pair of genomes i < j, from one row a position."""
    here = bases.join(snp_positions(bases), ["chr", "pan"], "left_semi")
    own = here.groupBy("chr", "pan").agg(F.collect_list(F.struct("acc", "nt")).alias("own"))
    pairs = own.select(F.explode("own").alias("a"), "own").select("a", F.explode("own").alias("b")).where("a.acc < b.acc")
    return pairs.groupBy(F.col("a.acc").alias("i"), F.col("b.acc").alias("j")).agg(F.sum((F.col("a.nt") != F.col("b.nt")).cast("long")).alias("d"), F.count("*").alias("n"))


def gaps(aln: DataFrame) -> DataFrame:
    """(chr, acc, beg, end): interior pan gaps of each genome whose flanks are consecutive in signed rank."""
    r = Scan(ranked(aln), ["chr", "acc"], ["pan"]).after(np="pan", nr="rank").table
    return r.where("np > pan + 1 AND nr - rank = 1").select("chr", "acc", (F.col("pan") + 1).alias("beg"), (F.col("np") - 1).alias("end"))


def sv_coverage(aln: DataFrame) -> DataFrame:
    """(chr, beg, end, depth): segments of the pan axis that a constant number of genomes lack."""
    from seqloom.operators.intervals import depth

    return depth(gaps(aln), ["chr"])


def sv_groups(aln: DataFrame) -> DataFrame:
    """(chr, beg, end, len): maximal runs that some genome lacks, widened by one on each side and held in the axis."""
    from seqloom.operators.intervals import merged

    runs = merged(gaps(aln), ["chr"], 1)
    top = aln.groupBy("chr").agg(F.max("pan").alias("top"))
    return runs.join(F.broadcast(top), "chr").select("chr", F.greatest(F.col("beg") - 1, F.lit(1)).alias("beg"), F.least(F.col("end") + 1, "top").alias("end"), "len")


def sv_genotypes(aln: DataFrame) -> DataFrame:
    """(chr, beg, end, len, acc, own_b, own_e, len_acc) of groups with a genome, none longer than the group.

    A genome counts where both borders are mapped on one strand and are neighbours in its order of borders.
    """
    g = sv_groups(aln)
    at = lambda side: aln.select("chr", "acc", F.col("pan").alias(side), F.col("own").alias(f"own_{side[0]}"))
    both = g.join(at("beg"), ["chr", "beg"]).join(at("end"), ["chr", "acc", "end"])
    marks = g.select("chr", F.col("beg").alias("pan"), F.lit(0.1).alias("e")).unionByName(g.select("chr", F.col("end").alias("pan"), F.lit(-0.1).alias("e")))
    keyed = marks.join(aln, ["chr", "pan"]).withColumn("k", F.abs(F.col("own") + F.col("e")))
    keyed = Scan(keyed, ["chr", "acc"], ["k"]).number("__n").table.withColumn("r", F.col("__n") * F.signum("own")).select("chr", "acc", "pan", "e", "r")
    rb = keyed.where("e > 0").select("chr", "acc", F.col("pan").alias("beg"), F.col("r").alias("rb"))
    re = keyed.where("e < 0").select("chr", "acc", F.col("pan").alias("end"), F.col("r").alias("re"))
    ok = both.join(rb, ["chr", "acc", "beg"]).join(re, ["chr", "acc", "end"]).where("re - rb = 1 AND own_b * own_e > 0")
    ok = ok.withColumn("len_acc", F.abs(F.col("own_b") - F.col("own_e")) - 1)
    most = F.max("len_acc").over(Window.partitionBy("chr", "beg", "end"))
    return ok.withColumn("__m", most).where(F.col("__m") <= F.col("len")).select("chr", "beg", "end", "len", "acc", "own_b", "own_e", "len_acc")


def sv_classes(genotypes: DataFrame, genomes: int, cutoff: float = 0.9, phasing: float = 0.1) -> DataFrame:
    """(chr, beg, end, len, freq_min, freq_max, freq_sum, single, name, type) of variants that vary.

    freq_max counts genomes with at least ``cutoff`` of the length, freq_min those with at most the rest;
    a genome without borders has length -1.  Single variants are insertions, deletions or
    indels by how many genomes hold them; others are complex.
    """
    known = genotypes.groupBy("chr", "beg", "end", "len").agg(
        F.sum((F.col("len_acc") <= (1 - cutoff) * F.col("len")).cast("long")).alias("low"), F.sum((F.col("len_acc") >= cutoff * F.col("len")).cast("long")).alias("freq_max"), F.count("*").alias("n")
    )
    c = known.withColumn("freq_min", F.col("low") + genomes - F.col("n")).withColumn("freq_sum", F.col("freq_min") + F.col("freq_max"))
    c = c.withColumn("single", (F.col("freq_sum") == genomes).cast("int"))
    c = c.where(~((F.col("freq_sum") == genomes) & ((F.col("freq_min") == 0) | (F.col("freq_max") == 0))))
    c, number = Scan(c, ["chr"], ["beg", "end"]).number("__n").table, F.col("__n")
    name = F.concat(F.lit("SVgr_"), F.col("chr").cast("string"), F.lit("_id_"), F.lpad(number.cast("string"), 6, "0"), F.lit("|"), F.col("len").cast("string"))
    kind = F.when(F.col("single") == 0, "complex").when(F.col("freq_max") <= phasing * genomes, "insertion").when(F.col("freq_max") >= (1 - phasing) * genomes, "deletion").otherwise("indel")
    return c.select("chr", "beg", "end", "len", "freq_min", "freq_max", "freq_sum", "single", name.alias("name"), kind.alias("type"))


def sv_size_table(classes: DataFrame, thresholds: tuple[int, ...] = (0, 15, 50, 100, 1000)) -> DataFrame:
    """(above, n, complex, simple, ratio): counts of variants longer than each threshold."""
    t = classes.withColumn("above", F.explode(F.array(*[F.lit(x) for x in thresholds]))).where("len > above")
    s = t.groupBy("above").agg(F.count("*").alias("n"), F.sum(1 - F.col("single")).alias("complex"), F.sum("single").cast("long").alias("simple"))
    return s.withColumn("ratio", F.round(F.col("simple") / F.col("n"), 2))


def sv_length_by_frequency(classes: DataFrame, bounds: tuple[int, ...] = (1, 2, 3, 5, 10, 15, 50, 100, 1000)) -> DataFrame:
    """(bin, freq, n, share): single variants by length bin [a, b) and presence, and the share among equal presence."""
    label = F.when(F.col("len") >= bounds[-1], F.lit(f"[{bounds[-1]},)"))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        label = label.when((F.col("len") >= a) & (F.col("len") < b), F.lit(f"[{a},{b})"))
    n = classes.where("single = 1").withColumn("bin", label).groupBy("bin", F.col("freq_max").alias("freq")).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("freq")), 9))


def sv_gff(genotypes: DataFrame, classes: DataFrame) -> DataFrame:
    """(chr, acc, beg, end, strand, name): variants in each genome's own coordinates, empty ones dropped."""
    g = genotypes.join(classes.select("chr", F.col("beg"), F.col("end"), "name"), ["chr", "beg", "end"]).where("len_acc > 0")
    lo, hi = F.least(F.abs("own_b"), F.abs("own_e")), F.greatest(F.abs("own_b"), F.abs("own_e"))
    return g.select("chr", "acc", (lo + 1).alias("beg"), (hi - 1).alias("end"), F.when(F.col("own_b") < 0, "-").otherwise("+").alias("strand"), "name")
