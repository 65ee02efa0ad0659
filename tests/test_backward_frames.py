import time

from pyspark.sql import functions as F

from seqloom.operators import coordinates as co
from seqloom.operators import runs as ru
from seqloom.plans import scan as sc


def test_following_values_in_one_pass(spark):
    """What comes after a row is found in time that grows with the axis, not with its square."""
    n = 200_000
    df = spark.range(n, numPartitions=4).select(F.lit(1).alias("key"), F.col("id").alias("pos"), F.when(F.col("id") == n - 1, 7).otherwise(0).alias("v"))
    begun = time.time()
    marked = df.withColumn("w", F.nullif("v", F.lit(0)))
    got = sc.Scan(marked, ["key"], ["pos"], False).next("x", "w").table.agg(F.count("*").alias("n"), F.sum("x").alias("s")).first()
    assert (got.n, got.s) == (n, 7 * (n - 1))
    got = ru.filled(df, ["key"]).agg(F.sum("next").alias("s"), F.count("prev").alias("p")).first()
    assert (got.s, got.p) == (7 * n, 1)
    got = ru.stretches(df, ["key"], value="v").agg(F.sum("fwd").alias("f"), F.sum("bwd").alias("b")).first()
    assert (got.f, got.b) == ((n - 1) * (n - 2) // 2, (n - 1) * n // 2)
    assert time.time() - begun < 60


def test_liftover_to_far_marks(spark):
    """Long stretches without a mapped position: items take the mark behind them."""
    n = 30_000
    aln = spark.createDataFrame([(1, a, p, p) for a in (1, 2) for p in (1, n)], "chr long, acc long, pan long, own long")
    items = spark.range(2, n - 1).select(F.lit(1).cast("long").alias("chr"), F.col("id"), F.col("id").alias("beg"), F.lit(n).cast("long").alias("end"), F.lit("+").alias("strand"))
    got = co.lift(items, aln, 1, 2, False).agg(F.count("*").alias("n"), F.min("beg2").alias("lo"), F.max("end2").alias("hi")).first()
    assert (got.n, got.lo, got.hi) == (n - 3, n, n)
