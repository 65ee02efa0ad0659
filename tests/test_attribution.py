from seqloom import catalogue
from seqloom.operators import graphs


def test_query_knows_components_of_every_id(spark, tmp_path):
    # customer -> 1 + order % 100: the chains 10 -> 20 -> 30 and 50 -> 60 -> 70.
    orders = [(10, 19), (20, 29), (50, 59), (60, 69)]
    spark.createDataFrame(orders, "o_custkey long, o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(100).write.parquet(f"{tmp_path}/customer.parquet")
    got = sorted(tuple(r) for r in catalogue.QUERIES["attribute_nodes"](spark, str(tmp_path)).select("node", "component").collect())
    assert got == [(10, 10), (20, 10), (30, 10), (50, 50), (60, 50), (70, 50)]


def test_attribution_in_turn(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (4, 1), (4, 2), (5, 4), (6, 1), (6, 9)], "src long, dst long")
    known = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node long, component long")
    got = {r.node: r.component for r in graphs.attributed(edges, known, 0.6).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
