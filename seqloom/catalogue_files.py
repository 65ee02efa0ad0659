"""Registered queries through files: tables written in each format to the shared folder and read back, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom import catalogue as ca
from seqloom.operators import coordinates as co
from seqloom.operators import similarity as si
from seqloom.plans import fixtures as fx
from seqloom.plans import tables as tb
from seqloom.plans.recovery import fresh_path
from seqloom.registry import add, on
from seqloom.sources import files as fs


# --- sequences ------------------------------------------------------------------------------------
def _fasta(spark: SparkSession, seqs: DataFrame, strict: bool = True) -> DataFrame:
    path = fresh_path(spark, "fasta")
    fs.write_fasta(seqs, path)
    return fs.read_fasta(spark, path, strict).select("name", "seq")


add("fasta_files", lambda spark, d: _fasta(spark, fx.seqs(spark, d).where("seq <> ''")), "SELECT name::VARCHAR AS name, seq FROM seqs WHERE seq <> ''", "seqs")
add("fasta_empty_records", lambda spark, d: _fasta(spark, fx.seqs(spark, d).withColumn("name", F.concat(F.lit("a b "), "name")), strict=False), "SELECT 'a_b_' || name AS name, coalesce(seq, '') AS seq FROM seqs WHERE seq IS NOT NULL", "seqs")


def _genome(spark: SparkSession, d: str) -> DataFrame:
    """The first ten records of one genome, as its chromosomes; its files hold ranges of names, so no task writes all of it."""
    path = fresh_path(spark, "genome")
    seqs = fx.seqs(spark, d).where("length(seq) > 50").withColumn("seq", F.lower("seq"))
    fs.write_fasta(seqs.orderBy("name"), path)
    return fs.chromosomes(fs.read_fasta(spark, path), "g1", 10)


add("genome_chromosomes", _genome, """SELECT 'g1' AS acc, row_number() OVER (ORDER BY name) AS chr, length(seq)::BIGINT AS len, name::VARCHAR AS name, seq FROM seqs WHERE length(seq) > 50 QUALIFY row_number() OVER (ORDER BY name) <= 10""", "seqs")


def _maf(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an alignment's export, with how often each comes."""
    path = fresh_path(spark, "maf")
    fs.write_maf(fx.aligned(spark, d), path)
    f = F.split("value", "\t")
    lines = spark.read.text(path).where("value LIKE 's%'").select(F.get(f, F.lit(1)).alias("row"), F.get(f, F.lit(3)).cast("long").alias("size"), F.get(f, F.lit(6)).alias("seq"))
    return lines.groupBy("row", "size", "seq").agg(F.count("*").alias("n"))


add("maf_lines", _maf, "SELECT row::VARCHAR AS row, length(replace(seq, '-', ''))::BIGINT AS size, seq, count(*) AS n FROM aligned GROUP BY ALL", fx.aligned_sql())


# --- tables ---------------------------------------------------------------------------------------
def _hits(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "hits")
    fs.write_hits(fx.hits(spark, d), path)
    return fs.read_hits(spark, path)


add("hit_files", _hits, "SELECT * REPLACE (q_id::VARCHAR AS q_id, s_id::VARCHAR AS s_id) FROM hits", "hits")


def _features(spark: SparkSession, d: str) -> DataFrame:
    """(chrom, source, type, beg, end, ..): an annotation of each order."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    beg = F.col("o_custkey") * 3 + 1
    return o.select(
        F.concat(F.lit("chr"), F.col("o_custkey") % 5).alias("chrom"), F.lit("x").alias("source"), F.when(F.col("o_orderstatus") == "F", "gene").otherwise("exon").alias("type"), beg.alias("beg"), (beg + F.col("o_orderkey") % 90).alias("end"),
        F.lit(None).cast("string").alias("score"), F.when(F.col("o_orderkey") % 2 == 0, "+").otherwise("-").alias("strand"), F.lit(".").alias("phase"), F.concat(F.lit("ID=o"), "o_orderkey", F.lit(";Status="), "o_orderstatus").alias("attributes"),
    )


def _gff(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "gff")
    fs.write_gff(_features(spark, d), path)
    g = fs.attributes(fs.read_gff(spark, path))
    return g.select("chrom", "type", "beg", "end", "score", "strand", F.col("fields")["ID"].alias("name"), F.col("fields")["Status"].alias("status"))


_FEATURES = """feat AS (SELECT 'chr' || (o_custkey % 5) AS chrom, CASE WHEN o_orderstatus = 'F' THEN 'gene' ELSE 'exon' END AS type, o_custkey * 3 + 1 AS beg, o_custkey * 3 + 1 + o_orderkey % 90 AS "end",
  CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, 'o' || o_orderkey AS name, o_orderstatus AS status FROM orders)"""
add("gff_files", _gff, """SELECT chrom, type, beg, "end", '.' AS score, strand, name, status FROM feat""", _FEATURES)


def _bed(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "bed")
    g = fs.attributes(_features(spark, d))
    fs.write_bed(g.select("chrom", (F.col("beg") - 1).alias("beg"), "end", F.col("fields")["ID"].alias("name"), F.lit("0").alias("score"), "strand"), path)
    return fs.read_bed(spark, path)


add("bed_files", _bed, """SELECT chrom, beg - 1 AS beg, "end", name, '0' AS score, strand FROM feat""", _FEATURES)


def _vcf(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "vcf")
    fs.write_vcf(ca.QUERIES["vcf_rows"](spark, d), path, [str(g) for g in ca.GENOMES])
    return fs.read_vcf(spark, path)


add("vcf_files", _vcf, ca.ORACLES["vcf_rows"])


def _positions(spark: SparkSession, d: str) -> DataFrame:
    """Positions of a file of three columns."""
    path = fresh_path(spark, "positions")
    p = fx.positions(spark, d).select(F.concat(F.lit("chr"), "chr").alias("chrom"), F.abs("own").alias("pos"), F.concat_ws("_", "acc", "pan").alias("info"))
    p.write.csv(path, sep="\t")
    return fs.read_positions(spark, path)


add("position_files", _positions, "SELECT 'chr' || chr AS chrom, abs(own) AS pos, acc || '_' || pan AS info FROM pos", "positions")


def _distances(spark: SparkSession, d: str) -> DataFrame:
    """Nations' distances by their numbers of customers, through a file of the lower triangle."""
    path = fresh_path(spark, "distances")
    n = spark.read.parquet(f"{d}/customer.parquet").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    rows = n.alias("a").join(n.alias("b"), F.col("a.k") >= F.col("b.k")).select(F.col("a.k").alias("i"), F.col("b.k").alias("j"), F.abs(F.col("a.n") - F.col("b.n")).alias("d"))
    lines = rows.groupBy("i").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("j", "d"))), lambda x: x["d"].cast("string")), " ").alias("value"))
    lines.coalesce(1).sortWithinPartitions("i").select("value").write.text(path)
    return fs.read_distances(spark, path)


add("distance_files", _distances, """WITH n AS (SELECT row_number() OVER (ORDER BY c_nationkey) AS k, count(*) AS n FROM customer GROUP BY c_nationkey)
SELECT a.k AS i, b.k AS j, abs(a.n - b.n)::DOUBLE AS d FROM n a, n b""")


# --- stores ---------------------------------------------------------------------------------------
def _store(spark: SparkSession, d: str) -> DataFrame:
    """A store of maps read genome by genome, each genome's rows counted; the store's own list says which there are."""
    path = fresh_path(spark, "maps")
    fs.write_map(fx.positions(spark, d), path)
    parts = [fs.read_map(spark, path, acc) for acc in fs.map_genomes(spark, path)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("acc", "chr").agg(F.count("*").alias("n"), F.sum("own").alias("own"), F.max("pan").alias("pan"))


add("map_store", _store, "SELECT acc, chr, count(*) AS n, sum(own)::BIGINT AS own, max(pan) AS pan FROM pos GROUP BY acc, chr", "positions")


def _found(spark: SparkSession, d: str) -> DataFrame:
    """Which pairs of chromosomes a folder of stores holds, and what each is complete with."""
    path, pos = fresh_path(spark, "stores"), fx.positions(spark, d)
    pairs = [(r.chr, r.chr + 1) for r in pos.select("chr").distinct().collect()]  # one row a chromosome
    for q, r in pairs:
        pos.where(F.col("chr") == q).write.parquet(f"{path}/comb_{q}_{r}_ref")
    names = [f"comb_{q}_{r}_ref" for q, r in pairs] + ["other_1_2", "comb_x"]
    out = None
    for q, r in fs.combinations(names, "comb"):
        at = fs.check_dir(spark, f"{path}/comb_{q}_{r}_ref")
        part = spark.read.parquet(at).agg(F.lit(q).alias("q"), F.lit(r).alias("r"), F.lit(fs.is_done(spark, at)).alias("done"), F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


add("found_combinations", _found, "SELECT chr::INTEGER AS q, (chr + 1)::INTEGER AS r, true AS done, count(*) AS n FROM pos GROUP BY chr", "positions")
add("common_prefix", lambda spark, d: tb.shared_prefix(spark.read.parquet(f"{d}/customer.parquet"), ["c_nationkey"], "c_name"), """
WITH m AS (SELECT c_nationkey, min(c_name) AS lo, max(c_name) AS hi FROM customer GROUP BY c_nationkey)
SELECT c_nationkey, substr(lo, 1, coalesce((SELECT max(k) FROM range(1, 100) t(k) WHERE k <= length(lo) AND substr(lo, 1, k::INT) = substr(hi, 1, k::INT)), 0)::INT) AS prefix FROM m""")

# --- dots of amino acids and against the reversed sequence --------------------------------------------
_AMINO = "pairs AS (SELECT p_partkey AS id, upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) || upper(p_type) AS s1, upper(p_type) || upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) AS s2 FROM part)"


def _amino(spark: SparkSession, d: str) -> DataFrame:
    name, kind = F.upper(F.regexp_replace("p_name", "[^A-Za-z]", "")), F.upper("p_type")
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.concat(name, kind).alias("s1"), F.concat(kind, name).alias("s2"))


add("dots_of_proteins", on(_amino, lambda p: si.dots(p, 6, 4)), f", {ca._DOTS} SELECT * FROM dots", _AMINO)
add("dots_reversed", on(_amino, lambda p: si.dots(p.withColumn("s2", F.reverse("s1")), 5, 4)), f""", turned AS (SELECT id, s1, reverse(s1) AS s2 FROM pairs),
 x AS (SELECT id, s1, s2, unnest(range(1, length(s1) - 3)) AS i FROM turned WHERE length(s1) >= 5), y AS (SELECT id, s1, s2, i, unnest(range(1, length(s2) - 3)) AS j FROM x)
SELECT id, i, j, (5 - hamming(substr(s1, i::INT, 5), substr(s2, j::INT, 5)))::BIGINT AS n FROM y WHERE 5 - hamming(substr(s1, i::INT, 5), substr(s2, j::INT, 5)) >= 4""", _AMINO)


# --- regions with their bases, and lifted tables -----------------------------------------------------
def _wanted(bases: DataFrame) -> DataFrame:
    """(id, chr, acc, beg, end): a region of each stretch of forty own positions of each genome."""
    n = F.floor(F.abs("own") / 40)
    spans = bases.groupBy("chr", "acc", n.alias("k")).agg(F.min(F.abs("own")).alias("beg"), F.max(F.abs("own")).alias("end"))
    return spans.where("acc < 2").select(F.concat_ws("_", "chr", "acc", "k").alias("id"), "chr", "acc", "beg", "end")


add(
    "region_sequences",
    on(fx.bases, lambda b: co.fragments(b, _wanted(b))),
    """, want AS (SELECT chr || '_' || acc || '_' || k AS id, chr, acc, beg, "end" FROM (SELECT chr, acc, abs(own) // 40 AS k, min(abs(own)) AS beg, max(abs(own)) AS "end" FROM nts WHERE acc < 2 GROUP BY ALL)),
 span AS (SELECT w.id, w.chr, least(a.pan, b.pan) AS lo, greatest(a.pan, b.pan) AS hi FROM want w JOIN nts a ON a.chr = w.chr AND a.acc = w.acc AND abs(a.own) = w.beg JOIN nts b ON b.chr = w.chr AND b.acc = w.acc AND abs(b.own) = w."end"),
 col AS (SELECT id, chr, lo, hi, unnest(range(lo, hi + 1)) AS pan FROM span), who AS (SELECT DISTINCT chr, acc FROM nts)
SELECT c.id, w.acc, c.lo AS pan_beg, c.hi AS pan_end, string_agg(coalesce(n.nt, '-'), '' ORDER BY c.pan) AS seq FROM col c JOIN who w ON w.chr = c.chr LEFT JOIN nts n ON n.chr = c.chr AND n.acc = w.acc AND n.pan = c.pan GROUP BY c.id, w.acc, c.lo, c.hi""",
    "positions",
    "bases",
)
add("bed_lifted", on(fx.positions, lambda a: co.lift_bed(ca._genes(a).withColumn("beg", F.col("beg") - 1), a, 1, 2)), f"SELECT * REPLACE (beg - 1 AS beg, beg2 - 1 AS beg2) FROM ({ca.ORACLES['liftover_exact']}) x")
add(
    "points_lifted",
    on(fx.positions, lambda a: co.lift_points(ca._genes(a).select("chr", "id", F.col("beg").alias("pos")), a, 1, 2)),
    f""", {ca._MAP} SELECT i.chr, i.id, i.beg AS pos, abs(m.y)::BIGINT AS pos2, CASE WHEN m.y < 0 THEN '-' ELSE '+' END AS strand2 FROM items i JOIN m ON m.chr = i.chr AND m.x = i.beg WHERE i.beg > 0""",
    "positions",
)
