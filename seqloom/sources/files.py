"""Readers and writers of sequence and annotation files.

Readers keep the order within a file by line or record numbers of that file; nothing relies on an order across
files.  Writers leave folders of part files, as Spark does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqloom.plans.groups import row_numbers

HITS = "q_id string, q_beg long, q_end long, s_beg long, s_end long, pident double, aln_len long, s_id string, q_len long, s_len long"
GFF = "chrom string, source string, type string, beg long, end long, score string, strand string, phase string, attributes string"
BED = "chrom string, beg long, end long, name string, score string, strand string"
POSITIONS = "chrom string, pos long, info string"


def _has_empty_file(spark: SparkSession, path: str) -> bool:
    """Whether a file that ``path`` names has no bytes: Spark's readers pass over such files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in store.globStatus(at) or []:
        for f in store.listStatus(found.getPath()) if found.isDirectory() else [found]:
            if f.isFile() and f.getLen() == 0 and f.getPath().getName()[0] not in "_.":
                return True
    return False


def read_fasta(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(file, number, name, seq): records of FASTA files of any size; blanks and tabs in names become ``_``.

    Files are read in splits: headers are counted for each split, and a record's lines meet by its number.
    ``strict`` raises on an empty file, text before the first header and records without a
    sequence; otherwise these give no record, or an empty sequence.
    """
    if strict and _has_empty_file(spark, path):
        raise ValueError(f"no records in an empty file below {path}")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "\r", "").alias("value"))
    head = F.col("value").startswith(">").cast("long")
    here = F.sum(head).over(Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    base = lines.groupBy("file", "split").agg(F.sum(head).alias("n")).select("file", "split", F.coalesce(before, F.lit(0)).alias("base"))
    known = lines.withColumn("here", here).join(base, ["file", "split"]).withColumn("number", F.col("base") + F.col("here"))
    held = F.transform(F.array_sort(F.collect_list(F.struct("split", "at", "value"))), lambda x: x["value"])
    parts = known.groupBy("file", "number").agg(held.alias("held"))
    name = F.regexp_replace(F.substr(F.get("held", F.lit(0)), F.lit(2)), "[ \t]", "_")
    body = F.when(F.col("number") > 0, F.slice("held", 2, F.size("held"))).otherwise(F.col("held"))
    parts = parts.select("file", "number", name.alias("name"), F.regexp_replace(F.array_join(body, ""), "\\s", "").alias("seq"))
    keep = F.col("number") > 0
    if strict:  # guards stand in the filter, where the optimizer has to evaluate them
        fail = lambda what: F.raise_error(F.concat(F.lit(f"{what} in "), F.col("file"))).cast("boolean")
        keep = F.when((F.col("number") == 0) & (F.col("seq") != ""), fail("no header at the start")).when((F.col("number") > 0) & (F.col("seq") == ""), fail("no sequence")).otherwise(keep)
    return parts.where(keep)


def _text(lines: DataFrame, head: str, path: str, mode: str) -> None:
    """Lines of one string column as text; every part file that a task writes begins with ``head``."""

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for pdf in batches:
            if first and len(pdf):
                first = False
                yield pd.DataFrame({"value": [head]})
            yield pd.DataFrame({"value": pdf.iloc[:, 0]})
        if first:
            yield pd.DataFrame({"value": [head]})

    lines.toDF("value").mapInPandas(kernel, "value string").write.mode(mode).text(path)


def write_fasta(df: DataFrame, path: str, mode: str = "overwrite", name: str = "name", seq: str = "seq") -> None:
    """One line for each header and sequence; ``mode`` may append."""
    df.select(F.concat(F.lit(">"), F.col(name).cast("string"), F.lit("\n"), F.col(seq)).alias("value")).write.mode(mode).text(path)


def named(df: DataFrame, prefix: str = "seq_", order: str = "number") -> DataFrame:
    """Sequences without names as prefix1, prefix2, .. by ``order``."""
    return row_numbers(df, [order], "__number").withColumn("name", F.concat(F.lit(prefix), F.col("__number").cast("string"))).drop("__number")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """A tabular hit file, every line of it a row; an empty one gives no rows."""
    return spark.read.csv(path, sep="\t", schema=HITS)


def write_hits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select(*[c.split(" ")[0] for c in HITS.split(", ")]).write.mode(mode).csv(path, sep="\t")


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=GFF, comment="#")


def write_gff(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nine tab-separated columns; every part file that a task writes starts with the version line."""
    cols = [F.coalesce(F.col(c.split(" ")[0]).cast("string"), F.lit(".")) for c in GFF.split(", ")]
    _text(df.select(F.concat_ws("\t", *cols)), "##gff-version 3", path, mode)


def attributes(gff: DataFrame) -> DataFrame:
    """``gff`` with a map of its ``k=v;..`` attributes."""
    return gff.withColumn("fields", F.str_to_map("attributes", F.lit(";"), F.lit("=")))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=BED, comment="#")


def write_bed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select(*[c.split(" ")[0] for c in BED.split(", ")]).write.mode(mode).csv(path, sep="\t")


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=POSITIONS, comment="#")


def write_vcf(vcf: DataFrame, path: str, samples: list[str], mode: str = "overwrite") -> None:
    """VCF rows from (chrom, pos, ref, alt, gts); every part file has the header."""
    head = "\t".join(["##fileformat=VCFv4.2\n#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])
    row = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.concat_ws("_", "chrom", F.col("pos").cast("string")), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."), F.lit("GT"), "gts")
    _text(vcf.select(row), head, path, mode)


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, ref, alt, gts): genotypes stay one tab-separated string."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    f = F.split("value", "\t")
    return lines.select(F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(1)).cast("long").alias("pos"), F.get(f, F.lit(3)).alias("ref"), F.get(f, F.lit(4)).alias("alt"), F.array_join(F.slice(f, 10, F.size(f)), "\t").alias("gts"))


def read_distances(spark: SparkSession, path: str) -> DataFrame:
    """(i, j, d): a symmetric matrix from the lower triangle; line i must hold i values.  One small file, one task."""
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.rtrim(F.regexp_replace("value", "\r", ""), F.lit("\n")), "\n")).alias("k", "line"))
    v = F.split(F.trim(F.col("line")), r"\s+")
    checked = F.when(F.size(v) != F.col("k") + 1, F.raise_error(F.format_string("line %d holds %d values", F.col("k") + 1, F.size(v))).cast("array<string>")).otherwise(v)
    low = raw.select((F.col("k") + 1).cast("long").alias("i"), F.posexplode(checked).alias("j", "d")).select("i", (F.col("j") + 1).cast("long").alias("j"), F.col("d").cast("double").alias("d"))
    return low.unionByName(low.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "d"))


def write_maf(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """An ``a`` block for each alignment of (aln, row, seq), with an ``s`` line for each row."""
    size = F.length(F.replace("seq", F.lit("-"), F.lit("")))
    line = F.concat_ws("\t", F.lit("s"), F.col("row").cast("string"), F.lit("0"), size.cast("string"), F.lit("+"), size.cast("string"), "seq")
    block = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", line.alias("line")))), lambda x: x["line"]), "\n")
    rows.groupBy("aln").agg(F.concat(F.lit("a\n"), block, F.lit("\n")).alias("value")).select("value").write.mode(mode).text(path)


def chromosomes(seqs: DataFrame, accession: str, most: int) -> DataFrame:
    """(acc, chr, len, name, seq): the first ``most`` records of a genome, in upper case; one in several files goes on from file to file by name."""
    # One row a file.
    before = F.sum("__n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    base = seqs.groupBy("file").agg(F.max("number").alias("__n")).select("file", F.coalesce(before, F.lit(0)).alias("__base"))
    seqs = seqs.where(F.col("number") <= most).join(base, "file").withColumn("number", F.col("__base") + F.col("number")).where(F.col("number") <= most)
    return seqs.where(F.col("number") <= most).select(F.lit(accession).alias("acc"), F.col("number").alias("chr"), F.length("seq").cast("long").alias("len"), "name", F.upper("seq").alias("seq"))


def accession(file: str) -> str:
    """The second-last dotted field of a file's name."""
    return file.rsplit("/", 1)[-1].split(".")[-2]


def combinations(names: list[str], kind: str) -> list[tuple[int, int]]:
    """(q, r) of file names ``<kind>_<q>_<r>[_ref].h5`` or folders of that form; others are left out."""
    found = (re.fullmatch(rf"{re.escape(kind)}_(\d+)_(\d+)(?:_.*)?(?:\.\w+)?", n.rsplit("/", 1)[-1]) for n in names)
    return sorted((int(m[1]), int(m[2])) for m in found if m)


def common_prefix(texts: list[str]) -> str:
    """The longest common prefix; empty for none."""
    if not texts:
        return ""
    lo, hi = min(texts), max(texts)
    n = next((i for i, (a, b) in enumerate(zip(lo, hi, strict=False)) if a != b), min(len(lo), len(hi)))
    return lo[:n]


def _store(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def check_file(spark: SparkSession, path: str) -> str:
    """``path`` if it is a file of any store that Spark reads, else it raises."""
    store, at = _store(spark, path)
    if not store.exists(at) or not store.getFileStatus(at).isFile():
        raise FileNotFoundError(path)
    return path


def check_dir(spark: SparkSession, path: str) -> str:
    """``path`` if it is a folder, else it raises."""
    store, at = _store(spark, path)
    if not store.exists(at) or not store.getFileStatus(at).isDirectory():
        raise NotADirectoryError(path)
    return path


def is_done(spark: SparkSession, log: str, word: str = "Done") -> bool:
    """Whether a line of a step's log holds ``word`` in any case; a table that Spark has written is done by its marker file."""
    store, at = _store(spark, log)
    if not store.exists(at):
        return False
    if store.getFileStatus(at).isDirectory():
        return bool(store.exists(spark._jvm.org.apache.hadoop.fs.Path(log + "/_SUCCESS")))
    return not spark.read.text(log).where(F.contains(F.lower("value"), F.lit(word.lower()))).isEmpty()


def prefixes(spark: SparkSession, path: str) -> list[str]:
    """The names of a folder's files up to the first dot, sorted, each once."""
    store, at = _store(spark, path)
    return sorted({f.getPath().getName().split(".")[0] for f in store.listStatus(at) if f.isFile() and f.getPath().getName()[0] not in "._"})


def write_map(aln: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A coordinate map as a store with one folder a genome, so that reading one touches no other."""
    aln.write.mode(mode).partitionBy("acc").parquet(path)


def read_map(spark: SparkSession, path: str, acc=None) -> DataFrame:
    """(chr, acc, pan, own) of a store, or of one genome of it."""
    found = spark.read.parquet(path).select("chr", "acc", "pan", "own")
    return found if acc is None else found.where(F.col("acc") == acc)


def map_genomes(spark: SparkSession, path: str) -> list:
    """The genomes of a store, from its folders alone."""
    return sorted(r.acc for r in spark.read.parquet(path).select("acc").distinct().collect())
