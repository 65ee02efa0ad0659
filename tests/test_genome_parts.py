from pyspark.sql import functions as F

from seqloom import catalogue_files
from seqloom.plans import fixtures as fx
from seqloom.sources import files as fs


def test_records_go_on_from_file_to_file(spark, tmp_path):
    rows = [(f"n{k:02}", "acgt" * (k + 1)) for k in range(9)]
    df = spark.createDataFrame(rows, "name string, seq string")
    fs.write_fasta(df.repartitionByRange(4, "name").sortWithinPartitions("name"), str(tmp_path / "g"))
    found = fs.read_fasta(spark, str(tmp_path / "g"))
    assert found.select("file").distinct().count() > 1
    got = fs.chromosomes(found, "g", 5).orderBy("chr").collect()
    assert [(r.chr, r.name, r.seq) for r in got if r.chr <= 5] == [(k + 1, n, s.upper()) for k, (n, s) in enumerate(rows[:5])]
    assert len(got) == 5


def test_no_task_writes_the_whole_genome(spark, monkeypatch):
    parts, write = [], fs.write_fasta
    monkeypatch.setattr(fs, "write_fasta", lambda df, path: parts.append(df) or write(df, path))
    got = catalogue_files._genome(spark, "/root/testdata/sf0.001")
    assert "Coalesce" not in parts[0]._jdf.queryExecution().executedPlan().toString()
    first = fx.seqs(spark, "/root/testdata/sf0.001").where("length(seq) > 50").orderBy("name").limit(10).select(F.col("name").cast("string")).collect()
    assert [r.name for r in got.orderBy("chr").collect()] == [r.name for r in first]
