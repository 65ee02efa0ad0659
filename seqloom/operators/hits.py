"""Similarity-hit tables: (q_id, q_beg, q_end, s_beg, s_end, pident, aln_len, s_id, q_len, s_len); s_beg > s_end marks the minus strand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.intervals import union_length
from seqloom.plans.groups import dealt, row_numbers, solve

PAIR = ["q_id", "s_id", "strand"]


def strand() -> Column:
    return F.when(F.col("s_beg") > F.col("s_end"), F.lit("-")).otherwise(F.lit("+"))


def by_identity(hits: DataFrame, least: float) -> DataFrame:
    return hits.where(F.col("pident") >= least)


def without_self(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("q_id") != F.col("s_id"))


def rescaled_to_bases(hits: DataFrame) -> DataFrame:
    """Amino-acid query coordinates and lengths as nucleotides."""
    return hits.withColumns({"q_beg": (F.col("q_beg") - 1) * 3 + 1, "q_end": F.col("q_end") * 3, "aln_len": F.col("aln_len") * 3, "q_len": F.col("q_len") * 3})


def sane(hits: DataFrame) -> DataFrame:
    """Rows whose coordinates are all positive."""
    return hits.where(F.least("q_beg", "q_end", "s_beg", "s_end") > 0)


def nestedness(hits: DataFrame, by_strand: bool = True) -> DataFrame:
    """(q_id, s_id, strand, cov_q, cov_s): how many positions of either side a pair's hits cover together."""
    h = hits.withColumn("strand", strand() if by_strand else F.lit("."))
    q = h.select(*PAIR, F.col("q_beg").alias("beg"), F.col("q_end").alias("end"))
    s = h.select(*PAIR, F.least("s_beg", "s_end").alias("beg"), F.greatest("s_beg", "s_end").alias("end"))
    return union_length(q, PAIR).withColumnRenamed("covered", "cov_q").join(union_length(s, PAIR).withColumnRenamed("covered", "cov_s"), PAIR)


def nestedness_table(hits: DataFrame) -> DataFrame:
    """The same with lengths and coverages as shares: name_query, name_target, strand, length_*, coverage_*."""
    h = hits.withColumn("strand", strand())
    lengths = h.groupBy(*PAIR).agg(F.first("q_len").alias("length_query"), F.first("s_len").alias("length_target"))
    n = nestedness(hits).join(lengths, PAIR)
    return n.select(
        F.col("q_id").alias("name_query"), F.col("s_id").alias("name_target"), "strand", "length_query", "length_target",
        F.round(F.col("cov_q") / F.col("length_query"), 9).alias("coverage_query"), F.round(F.col("cov_s") / F.col("length_target"), 9).alias("coverage_target"),
    )


def cutoff_share(cutoff: float) -> float:
    """10 to 100 as a percentage, 0 to 1 as it is."""
    if 0 <= cutoff <= 1:
        return cutoff
    if 10 <= cutoff <= 100:
        return cutoff / 100
    raise ValueError("a coverage cutoff is a share or a percentage")


def filter_nestedness(n: DataFrame, coverage: float | None = None, least: int | None = None, most: int | None = None, names: list | None = None, copies: bool = False) -> DataFrame:
    """Rows where either side's coverage is enough, both lengths fit and no name is excluded.

    ``copies`` keeps only names that have a partner with mutual coverage and length ratios of ``coverage``.
    """
    if names:
        n = n.where(~F.col("name_query").isin(names) & ~F.col("name_target").isin(names))
    share = None if coverage is None else cutoff_share(coverage)
    if share is not None:
        n = n.where((F.col("coverage_query") >= share) | (F.col("coverage_target") >= share))
    if least is not None:
        n = n.where(F.least("length_query", "length_target") >= least)
    if most is not None:
        n = n.where(F.greatest("length_query", "length_target") <= most)
    if copies and share is not None:
        ratio = F.least(F.col("length_query") / F.col("length_target"), F.col("length_target") / F.col("length_query"))
        mutual = n.where((F.least("coverage_query", "coverage_target") >= share) & (ratio >= share) & (F.col("name_query") != F.col("name_target")))
        good = mutual.select(F.explode(F.array("name_query", "name_target")).alias("name")).distinct()
        n = n.join(good, n.name_query == good.name, "left_semi").join(good, n.name_target == good.name, "left_semi")
    return n


def nested_edges(n: DataFrame, coverage: float) -> DataFrame:
    """(src, dst) from each sequence that is covered to the one that holds it."""
    c = cutoff_share(coverage)
    fwd = n.where((F.col("coverage_query") >= c) & (F.col("length_target") / F.col("length_query") >= c)).select(F.col("name_query").alias("src"), F.col("name_target").alias("dst"))
    bwd = n.where((F.col("coverage_target") >= c) & (F.col("length_query") / F.col("length_target") >= c)).select(F.col("name_target").alias("src"), F.col("name_query").alias("dst"))
    return fwd.union(bwd).where("src <> dst").distinct()


def contingency(hits: DataFrame) -> DataFrame:
    """(q_id, s_id, n, total): hits of each query and target, beside the query's total."""
    counts = hits.groupBy("q_id", "s_id").agg(F.count("*").alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy("q_id")))


def copy_matrix(hits: DataFrame, genomes: list) -> DataFrame:
    """One row a query and one column a genome with the number of hits, 0 where there are none."""
    wide = hits.groupBy("q_id").pivot("s_id", genomes).agg(F.count(F.lit(1))).fillna(0)
    return wide.select("q_id", *[F.col(str(g)).alias(f"g{g}") for g in genomes])


def hits_per_query(hits: DataFrame) -> DataFrame:
    """(mean, least, most) hits of the queries that have any."""
    n = hits.groupBy("q_id").agg(F.count("*").alias("n"))
    return n.agg(F.round(F.avg("n"), 9).alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"))


def glued(hits: DataFrame) -> DataFrame:
    """Chains of plus-strand hits that follow each other exactly on both axes, as one hit each: (.., n).

    Minus-strand hits are never glued.
    """
    h = dealt(hits.withColumn("strand", strand()), *PAIR)
    by = Window.partitionBy(*PAIR).orderBy("q_beg", "q_end", "s_beg", "s_end", "pident")
    joined = (F.col("strand") == "+") & (F.col("q_beg") == F.lag("q_end").over(by) + 1) & (F.col("s_beg") == F.lag("s_end").over(by) + 1)
    h = h.withColumn("__new", F.when(joined, 0).otherwise(1)).withColumn("__g", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    span = [F.min("q_beg").alias("q_beg"), F.max("q_end").alias("q_end"), F.when(F.first("strand") == "+", F.min("s_beg")).otherwise(F.max("s_beg")).alias("s_beg"), F.when(F.first("strand") == "+", F.max("s_end")).otherwise(F.min("s_end")).alias("s_end")]
    return h.groupBy("q_id", "s_id", "strand", "__g").agg(*span, F.count("*").alias("n")).drop("__g")


def chain_pair(rows: list[tuple], q_len: int, coverage: float, similarity: float) -> list[tuple]:
    """Merged hits of one query, target and strand: (q_beg, q_end, s_beg, s_end, pident, cover).

    ``rows`` are partial hits (q_beg, q_end, s_beg, s_end, pident) on a forward target axis.
    Nested hits fall, chains break where the target gap is too wide, a hit ends before the one before it
    begins or both its ends lie before those of that one on the query, and a chain stays if its own cover, its identity and the span on the target fit.
    """
    if len(rows) < 2:
        return []
    kept: list[tuple] = []
    for r in sorted(rows, key=lambda r: (r[2], -r[3], r[0], r[1])):
        k = kept[-1] if kept else None
        if not (k and r[0] >= k[0] and r[1] <= k[1] and r[2] >= k[2] and r[3] <= k[3]):
            kept.append(r)
    chains: list[list[tuple]] = []
    for i, r in enumerate(kept):
        p = kept[i - 1] if i else None
        back = p is not None and (r[1] < p[0] or (r[0] < p[0] and r[1] < p[1]))
        if p is None or back or r[2] - p[3] - 1 > q_len * (1 - coverage):
            chains.append([])
        chains[-1].append(r)
    out = []
    for chain in (c for c in chains if len(c) > 1):
        flat: list[tuple] = []
        for r in sorted(chain, key=lambda r: (r[0], -r[1], r[2], r[3])):
            if not (flat and r[1] <= flat[-1][1]):
                flat.append(r)
        own = [r[1] - r[0] + 1 + (min(0, flat[i + 1][0] - r[1] - 1) if i + 1 < len(flat) else 0) for i, r in enumerate(flat)]
        cover = sum(own)
        ident = sum(r[4] * c for r, c in zip(flat, own, strict=True)) / cover
        s_beg, s_end = min(r[2] for r in flat), max(r[3] for r in flat)
        span = s_end - s_beg + 1
        if cover / q_len > coverage and ident > 100 * similarity and span / q_len > coverage and q_len / span > coverage:
            out.append((min(r[0] for r in flat), max(r[1] for r in flat), s_beg, s_end, ident, cover))
    return out


def merged_hits(hits: DataFrame, similarity: float, coverage: float | None = None) -> DataFrame:
    """Hits that cover enough of their query, and chains of partial hits that do so together.

    A group is one query, target and strand; its partial hits are chained in one task.
    """
    cov = similarity if coverage is None else coverage
    cols = "q_id long, q_beg long, q_end long, s_beg long, s_end long, pident double, cover long, s_id long, q_len long, strand string"
    names = [c.split(" ")[0] for c in cols.split(", ")]
    h = hits.withColumn("strand", strand())
    whole = F.col("aln_len") / F.col("q_len") > cov
    full = h.where(whole).withColumn("cover", F.col("q_end") - F.col("q_beg") + 1).select(*names)
    part = h.where(~whole).withColumn("__n", F.count("*").over(Window.partitionBy(*PAIR))).where("__n > 1").drop("__n")

    def kernel(key: tuple, rows: list[tuple]) -> list[tuple]:
        q, s, side = key
        sign = 1 if side == "+" else -1
        q_len = rows[0][-1]
        found = chain_pair([(a, b, *((c, d) if sign == 1 else (-c, -d)), i) for a, b, c, d, i, _ in rows], q_len, cov, similarity)
        return [(q, a, b, sign * c, sign * d, i, n, s, q_len, side) for a, b, c, d, i, n in found]

    part = part.select(*PAIR, "q_beg", "q_end", "s_beg", "s_end", "pident", "q_len")
    return full.unionByName(solve(part, PAIR, kernel, cols))


def to_gff(hits: DataFrame) -> DataFrame:
    """GFF rows of merged hits, ids numbered in the order of query, target and place, sorted by target and begin."""
    hits = row_numbers(hits, ["q_id", "s_id", "q_beg", "s_beg", "s_end", "pident"], "__number")
    note = F.format_string("ID=Q%d;query=%s;length=%d;similarity=%.2f;coverage=%.2f", F.col("__number"), F.col("q_id").cast("string"), F.col("q_len"), F.col("pident"), F.col("cover") / F.col("q_len"))
    return hits.select(
        F.col("s_id").cast("string").alias("chrom"), F.lit("seqloom").alias("source"), F.lit("hit").alias("type"), F.least("s_beg", "s_end").alias("beg"), F.greatest("s_beg", "s_end").alias("end"),
        F.lit(".").alias("score"), "strand", F.lit(".").alias("phase"), note.alias("attributes"),
    ).orderBy("chrom", "beg")

