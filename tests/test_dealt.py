import pytest
from pyspark.sql import functions as F

from seqloom.operators import hits as ht
from seqloom.operators import intervals as iv
from seqloom.operators import kernels as ke
from seqloom.plans import fixtures as fx
from seqloom.plans import groups as gr
from seqloom.plans import scan as sc

D = "/root/testdata/sf0.001"


def made(spark, name):
    """A result of intervals or hits that are read from files."""
    if name == "scan":
        return iv.merged(fx.intervals(spark, D).select((F.col("beg") % 100).alias("key"), (F.col("key") * 1000 + F.col("beg")).alias("beg"), (F.col("key") * 1000 + F.col("end")).alias("end")), ["key"])
    h = fx.hits(spark, D)
    return ht.glued(h) if name == "glued" else ke.clean_overlaps(h)


@pytest.mark.parametrize("name", ["scan", "glued", "solved"])
def test_tasks_grow_with_the_files(spark, monkeypatch, name):
    """A shuffle of its own has as many tasks as the session says; with larger files a task's rows stay as many, and the result is the same."""
    few = made(spark, name)
    whole = sorted(map(str, few.collect()))
    monkeypatch.setattr(gr, "SHARE", max(1, gr.source_bytes(fx.intervals(spark, D)) // 40))
    assert sorted(map(str, made(spark, name).collect())) == whole and whole
    used = made(spark, name).select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 8 >= few.select(F.spark_partition_id().alias("p")).distinct().count()


def test_counted_rows_make_tasks(spark, monkeypatch):
    """A table whose rows were counted is dealt by them, in ranges of an axis too."""
    one = fx.intervals(spark, D).select((F.col("key") % 3).alias("key"), "beg", "end")
    whole = sorted(map(str, iv.merged(one, ["key"]).collect()))
    monkeypatch.setattr(sc, "SMALL", 0)
    monkeypatch.setattr(sc, "TASK", 500)
    for rows in (1 << 40, 0):
        monkeypatch.setattr(sc, "ROWS", rows)
        scan = sc.Scan(one, ["key"], ["beg", "end"])
        assert scan.split == (not rows) and scan.df.rdd.getNumPartitions() == one.count() // 500
        assert sorted(map(str, iv.merged(one, ["key"]).collect())) == whole
    assert gr.source_bytes(spark.range(5).withColumn("x", F.lit(1))) < gr.SHARE
