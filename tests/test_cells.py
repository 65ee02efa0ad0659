from pyspark.sql import functions as F

from seqloom.operators import alignment as am


def test_cells_travel_as_numbers(spark):
    """Symbols beyond ASCII, empty and null ones, equal columns, and no struct for each cell in the shuffle."""
    cells = [("x", 0, c, s) for c, s in [(3, "é"), (1, "A"), (2, None), (4, "😀"), (4, "C"), (10, "-"), (6, "")]] + [("x", 1, 1, None), ("y", 0, 1, "-")]
    df = spark.createDataFrame(cells, "aln string, row long, col long, nt string").repartition(3)
    assert {(r.aln, r.row): r.seq for r in am.to_strings(df).collect()} == {("x", 0): "AéC😀-", ("x", 1): "", ("y", 0): "-"}
    assert {(r.aln, r.row): r.seq for r in am.to_strings(df, False).collect()} == {("x", 0): "AéC😀", ("x", 1): "", ("y", 0): ""}
    plan = am.to_strings(spark.range(1).select(F.lit(1).alias("aln"), F.lit(1).alias("row"), F.col("id").alias("col"), F.lit("A").alias("nt")))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct" not in plan
