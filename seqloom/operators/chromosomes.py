"""Genomes as chromosomes (acc, chr, seq): own-coordinate sequences, rebuilding, ordering and choice by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.sequence import rev_compl
from seqloom.operators.intervals import containment_join


def _piece(seq: Column, beg: Column, end: Column) -> Column:
    return F.substr(seq, beg.cast("int"), F.greatest(end - beg + 1, F.lit(0)).cast("int"))


def own_sequences(spans: DataFrame, genomes: DataFrame) -> DataFrame:
    """(chr, acc, id, strand, beg, end, len, seq): what lies between signed own coordinates own_b and own_e, both left out.

    Minus-strand sequences are reverse complements with beg and end negative; an end of 0 gives an
    empty sequence without a strand; ends of different signs raise.
    """
    b, e = F.col("own_b"), F.col("own_e")
    none, minus = (b == 0) | (e == 0), (b < 0) | (e < 0)
    bad = F.when(b * e < 0, F.raise_error(F.lit("begin and end have different signs")).cast("string"))
    strand = F.coalesce(bad, F.when(none, "").when(minus, "-").otherwise("+"))
    s = spans.select("chr", "acc", "id", strand.alias("strand"), F.when(minus, -e + 1).otherwise(b + 1).alias("lo"), F.when(minus, -b - 1).otherwise(e - 1).alias("hi"))
    s = s.join(genomes.select("chr", "acc", F.col("seq").alias("whole")), ["chr", "acc"])
    text = _piece(F.col("whole"), F.col("lo"), F.col("hi"))
    seq = F.when(F.col("strand") == "", "").when(F.col("strand") == "-", rev_compl(text)).otherwise(text)
    ends = {"+": (F.col("lo"), F.col("hi")), "-": (-F.col("hi"), -F.col("lo"))}
    pick = lambda k: F.when(F.col("strand") == "+", ends["+"][k]).when(F.col("strand") == "-", ends["-"][k]).otherwise(0).cast("long")
    length = F.when(F.col("strand") == "", 0).otherwise(F.col("hi") - F.col("lo") + 1).cast("long")
    return s.select("chr", "acc", "id", "strand", pick(0).alias("beg"), pick(1).alias("end"), length.alias("len"), seq.alias("seq"))


def variant_sequences(classes: DataFrame, consensus: DataFrame, least: int = 15, big: int = 50, most: int = 30_000, unknown: float = 0.5) -> DataFrame:
    """(name, size, seq): the consensus (chr, pan, nt) inside each simple variant (chr, beg, end, len, single, name).

    ``size`` is small below ``big`` positions; variants outside ``least`` .. ``most`` - 1 and sequences of more than ``unknown`` N go.
    """
    kept = classes.where((F.col("single") == 1) & (F.col("len") >= least) & (F.col("len") < most) & (F.col("end") - F.col("beg") > 1))
    inner = kept.select("chr", "name", "len", (F.col("beg") + 1).alias("beg"), (F.col("end") - 1).alias("end"))
    points = consensus.select("chr", F.col("pan").alias("beg"), F.col("pan").alias("end"), "nt")
    found = containment_join(points, inner, ["chr"], 1 << 12)
    seqs = found.groupBy("chr", F.col("name_b").alias("name"), F.col("len_b").alias("len")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("beg_a", "nt_a"))), lambda x: x["nt_a"]), "").alias("seq"))
    n = F.length("seq") - F.length(F.translate("seq", "N", ""))
    return seqs.where(n <= unknown * F.length("seq")).select("name", F.when(F.col("len") < big, "small").otherwise("big").alias("size"), "seq")


def common_keys(rows: DataFrame, key: str, group: str) -> DataFrame:
    """(key): the values of ``key`` that every ``group`` has."""
    n = rows.select(group).distinct().count()
    return rows.groupBy(key).agg(F.countDistinct(group).alias("n")).where(F.col("n") == n).select(key)


def rebuilt(pieces: DataFrame, genomes: DataFrame) -> DataFrame:
    """(acc, chr, seq): chromosomes put together from pieces (acc, i_ref, i_acc, beg, end, pos) of a genome in order of abs(pos).

    Pieces of negative ``pos`` are reverse-complemented.  Only reference chromosomes that every genome has come out.
    """
    p = pieces.join(common_keys(pieces, "i_ref", "acc"), "i_ref", "left_semi")
    p = p.join(genomes.select("acc", F.col("chr").alias("i_acc"), "seq"), ["acc", "i_acc"])
    text = _piece(F.col("seq"), F.col("beg"), F.col("end"))
    p = p.select("acc", "i_ref", F.abs("pos").alias("at"), F.when(F.col("pos") < 0, rev_compl(text)).otherwise(text).alias("text"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "")
    return p.groupBy("acc", F.col("i_ref").alias("chr")).agg(whole.alias("seq"))


def correspondence(hits: DataFrame, sizes: DataFrame) -> DataFrame:
    """(acc, i_ref, i_acc): for each reference chromosome the genome's one with most aligned positions, negative if most are inverted.

    ``hits`` is (acc, i_acc, i_ref, len, dir), ``sizes`` (acc, n) the number of chromosomes of each
    genome.  Genomes go whose chromosomes do not correspond one to one.
    """
    total = hits.groupBy("acc", "i_ref", "i_acc").agg(F.sum("len").alias("n"), F.sum(F.when(F.col("dir") == 1, F.col("len")).otherwise(0)).alias("back"))
    rank = F.row_number().over(Window.partitionBy("acc", "i_ref").orderBy(F.desc("n"), "i_acc"))
    best = total.withColumn("r", rank).where("r = 1")
    best = best.select("acc", "i_ref", F.when(2 * F.col("back") > F.col("n"), -F.col("i_acc")).otherwise(F.col("i_acc")).alias("i_acc"))
    fit = best.groupBy("acc").agg(F.countDistinct(F.abs("i_acc")).alias("d"), F.count("*").alias("k")).join(sizes, "acc").where("d = k and k = n").select("acc")
    return best.join(fit, "acc", "left_semi")


def resorted(genomes: DataFrame, corresponds: DataFrame) -> DataFrame:
    """(acc, chr, name, seq): chromosomes under the reference's numbers, inverted ones reverse-complemented."""
    c = corresponds.select("acc", F.abs("i_acc").alias("chr"), "i_ref", (F.col("i_acc") < 0).alias("back"))
    g = genomes.join(c, ["acc", "chr"])
    return g.select("acc", F.col("i_ref").alias("chr"), F.concat_ws("_Chr", F.col("acc").cast("string"), F.col("i_ref").cast("string")).alias("name"), F.when(F.col("back"), rev_compl(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def _any(words: list[str]) -> Column:
    return F.col("name").rlike("|".join(f"(?:{w})" for w in words))


def kept_by_name(seqs: DataFrame, remain: list[str] | None = None, remove: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``seqs`` (acc, name, ..) with kept: names that match any of ``remain`` (or all) and none of ``remove``, or any of ``keep``."""
    seqs = seqs.withColumn("name", F.replace("name", F.lit(" "), F.lit("_")))
    out = _any(remain) if remain else F.lit(True)
    if remove:
        out = out & ~_any(remove)
    if keep:
        out = out | _any(keep)
    return seqs.withColumn("kept", out)


def kept_counts(chosen: DataFrame) -> DataFrame:
    """(acc, remained, removed) of ``kept_by_name``."""
    return chosen.groupBy("acc").agg(F.count_if("kept").alias("remained"), F.count_if(~F.col("kept")).alias("removed"))
