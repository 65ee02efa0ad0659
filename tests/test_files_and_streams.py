import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import runs as rn
from seqloom.plans import fixtures as fx
from seqloom.sources import files as fs
from seqloom.streaming import events as ev


def test_fasta(spark, tmp_path):
    p = tmp_path / "a.fasta"
    p.write_text(">one 1\nACGT\nAC\n>two\tx\nGG\n")
    got = [(r.number, r["name"], r.seq) for r in fs.read_fasta(spark, str(p)).orderBy("number").collect()]
    assert got == [(1, "one_1", "ACGTAC"), (2, "two_x", "GG")]
    df = spark.createDataFrame([(1, "x", "ACGT"), (2, "y", "")], "number long, name string, seq string")
    fs.write_fasta(df, str(tmp_path / "out"))
    back = fs.read_fasta(spark, str(tmp_path / "out"), strict=False)
    assert sorted((r["name"], r.seq) for r in back.collect()) == [("x", "ACGT"), ("y", "")]
    for text in ("", "ACGT\n", ">only\n"):
        q = tmp_path / "bad.fasta"
        q.write_text(text)
        with pytest.raises(Exception, match="no (records|header|sequence)"):
            fs.read_fasta(spark, str(q)).collect()
        assert [r.seq for r in fs.read_fasta(spark, str(q), strict=False).collect()] == ([""] if ">" in text else [])
    assert [r["name"] for r in fs.named(df.drop("name")).collect()] == ["seq_1", "seq_2"]


def test_fasta_in_splits(spark, tmp_path):
    rng = random.Random(2)
    want = {}
    for f in ("a", "b"):
        records = [(f"{f}{i}", ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(rng.randrange(1, 12))]) for i in range(80)]
        (tmp_path / f"{f}.fasta").write_text("".join(f">{n}\n" + "\n".join(x) + "\n" for n, x in records))
        want |= {(f, i): (n, "".join(x)) for i, (n, x) in enumerate(records, 1)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    got = fs.read_fasta(spark, str(tmp_path / "*.fasta")).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {(r.file[-7], r.number): (r["name"], r.seq) for r in got} == want and len(got) == len(want)


def test_tables(spark, tmp_path):
    gff = spark.createDataFrame([("c1", "s", "gene", 5, 9, ".", "+", ".", "ID=a;k=v")], fs.GFF)
    fs.write_gff(gff, str(tmp_path / "g"))
    for n, df in enumerate((gff, gff.repartition(3), gff.where("beg > 99"))):
        fs.write_gff(df, str(tmp_path / f"g{n}"))
        parts = list((tmp_path / f"g{n}").glob("*.txt"))
        assert parts and all(p.read_text().startswith("##gff-version 3\n") for p in parts)
        assert fs.read_gff(spark, str(tmp_path / f"g{n}")).count() == df.count()
    assert fs.attributes(fs.read_gff(spark, str(tmp_path / "g"))).first().fields == {"ID": "a", "k": "v"}
    vcf = spark.createDataFrame([("1", 7, "A", "C,G", "0/0\t2/2")], "chrom string, pos long, ref string, alt string, gts string")
    fs.write_vcf(vcf, str(tmp_path / "v"), ["x", "y"])
    assert fs.read_vcf(spark, str(tmp_path / "v")).collect() == vcf.collect()
    hits = spark.createDataFrame([("q", 1, 2, 3, 4, 90.5, 2, "s", 10, 20)], fs.HITS)
    fs.write_hits(hits, str(tmp_path / "h"))
    assert fs.read_hits(spark, str(tmp_path / "h")).collect() == hits.collect()
    bed = spark.createDataFrame([("c", 0, 5, "n", ".", "+")], fs.BED)
    fs.write_bed(bed, str(tmp_path / "b"))
    assert fs.read_bed(spark, str(tmp_path / "b")).collect() == bed.collect()
    (tmp_path / "d.txt").write_text("0\n0.5 0\n0.2 0.3 0\n")
    assert {(r.i, r.j): r.d for r in fs.read_distances(spark, str(tmp_path / "d.txt")).collect()}[1, 3] == 0.2
    (tmp_path / "d.txt").write_text("0\n0.5\n")
    with pytest.raises(Exception, match="holds"):
        fs.read_distances(spark, str(tmp_path / "d.txt")).collect()
    fs.write_maf(spark.createDataFrame([(1, 0, "AC-"), (1, 1, "A-G")], "aln long, row long, seq string"), str(tmp_path / "m"))
    assert fs.combinations(["pan_1_1.h5", "pan_2_1_ref.h5", "pan_x_1.h5"], "pan") == [(1, 1), (2, 1)]
    assert fs.common_prefix(["abc", "abd", "ab"]) == "ab" and fs.common_prefix([]) == ""
    assert fs.accession("x/y.acc.txt") == "acc"


def test_streams(spark, tmp_path):
    flags = fx.flags(spark, "/root/testdata/sf0.001").select("key", "pos", "flag")
    flags.repartition(1).write.parquet(str(tmp_path / "f"))
    stream = spark.readStream.schema(flags.schema).parquet(str(tmp_path / "f"))
    q = ev.flag_runs(stream).writeStream.format("memory").queryName("runs").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {tuple(r) for r in spark.table("runs").collect()}
    ends = {r.key: r.m for r in flags.groupBy("key").agg(F.max("pos").alias("m")).collect()}
    want = {tuple(r) for r in rn.runs_of_ones(flags, ["key"]).collect() if r.end != ends[r.key]}
    assert got == want
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.write.parquet(str(tmp_path / "e"))
    s = ev.window_content(spark.readStream.schema(e.schema).parquet(str(tmp_path / "e")))
    q = s.writeStream.format("memory").queryName("content").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r)[:3] for r in spark.table("content").collect()} == {tuple(r)[:3] for r in ev.window_content(e).collect()}
