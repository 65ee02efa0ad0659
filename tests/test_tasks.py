import pytest
from pyspark.sql import functions as F

from seqloom.operators import kernels as ke
from seqloom.operators import refine as rf
from seqloom.operators import search as sr


@pytest.mark.parametrize("name", ["pairwise", "stars", "refined", "merged", "blocks", "masked", "two"])
def test_small_tables_reach_all_tasks(spark, name):
    """Work that costs more than its bytes tell is dealt to as many tasks as a shuffle has; a null key is one group."""
    pairs = spark.createDataFrame([(k if k else None, "ACGTACGTTT", "ACGTCGTTT") for k in range(200)], "id long, s1 string, s2 string").coalesce(1)
    rows = pairs.select("id", F.posexplode(F.array("s1", "s2")).alias("row", "seq"))
    sides = rows.select("id", (F.col("row") + 1).alias("side"), "row", "seq")
    made = {
        "pairwise": lambda: ke.pairwise(pairs), "stars": lambda: ke.star_alignments(rows.select("id", "seq")), "refined": lambda: rf.refined_alignments(rows), "merged": lambda: rf.merged_profiles(sides),
        "blocks": lambda: rf.shared_blocks(rf.merged_profiles(sides)), "masked": lambda: ke.mask_unaligned(rows.select(F.col("id").alias("aln"), "row", F.rpad("seq", 12, "-").alias("seq"))),
        "two": lambda: sr.two_sequences(pairs.select("id", F.repeat("s1", 9).alias("s1"), F.repeat("s1", 9).alias("s2"))),
    }[name]()
    key = made.columns[0]
    if name != "two":
        assert made.select(F.spark_partition_id().alias("p")).distinct().count() == 8
    got = made.groupBy(key).count().collect()
    assert len({r[key] for r in got}) == len(got) == 200 and len({r["count"] for r in got}) == 1
