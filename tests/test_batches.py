import random

import pyarrow as pa
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.operators import graphs as gr
from seqloom.operators import modularity as mo
from seqloom.operators import similarity as si
from seqloom.plans.groups import gathered


def test_shares_of_many_texts():
    rng = random.Random(3)
    texts = [None, "", "---", *["".join(rng.choice("ACé-") for _ in range(rng.randrange(30))) for _ in range(200)]]
    marks = [None if rng.random() < 0.1 else "".join(rng.choice("01") for _ in range(len(t or "") + rng.randrange(3))) for t in texts]

    def plain(text, mark):
        if text is None or mark is None:
            return None
        at, shares = 0, []
        for run in text.split("-"):
            if run:
                shares.append(mark[at : at + len(run)].count("1") / len(run))
            at += len(run) + 1
        return max(shares, default=None)

    assert codes.differing_shares(pa.array(texts, pa.string()), pa.array(marks, pa.string())).to_pylist() == [plain(*x) for x in zip(texts, marks, strict=True)]
    assert codes.differing_shares(pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []


def test_small_batches_come_together():
    one = lambda k: pa.RecordBatch.from_pydict({"x": [k, k]})
    got = list(gathered((one(k) for k in range(7)), 6))
    assert [b.num_rows for b in got] == [6, 6, 2] and pa.Table.from_batches(got).column(0).to_pylist() == [k for k in range(7) for _ in range(2)]
    assert list(gathered(iter([]))) == []


def test_distances_and_edges_are_read_once(spark):
    """What is behind the given rows is computed once, however often they are read."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    near = spark.createDataFrame([(1, 0, 1, 0.1), (1, 0, 2, 2.0), (1, 1, 2, 2.0)], "aln long, i long, j long, d double").repartition(1)
    found = si.clusters(near.mapInArrow(counted, near.schema), 0.9)
    assert {(r.row, r.cluster) for r in found.collect()} == {(0, 0), (1, 0), (2, 2)} and seen.value == 3
    seen = spark.sparkContext.accumulator(0)
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (8, 9)], "src long, dst long").repartition(1)
    assert {(r.node, r.component) for r in gr.families(edges.mapInArrow(counted, edges.schema)).collect()} == {(1, 1), (2, 1), (3, 1)} and seen.value == 4


def test_rounds_broadcast_nothing(spark):
    edges = spark.createDataFrame([(a, b) for g in (0, 10) for a in range(g, g + 4) for b in range(a + 1, g + 4)] + [(0, 10)], "src long, dst long")
    links = mo.cut(mo._weights(edges))
    nodes = mo.cut(links.groupBy(F.col("u").alias("node")).agg(F.lit(0).cast("long").alias("loop"), F.sum("w").alias("k")))
    level = mo._Level(links, nodes, nodes.agg(F.sum("k")).first()[0])
    plans = []
    held, mo.cut = mo.cut, lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), held(df))[1]
    try:
        level.settle(1e-3)
        level.condensed()
    finally:
        mo.cut = held
    assert len(plans) > 3 and not any("BroadcastHashJoin" in p for p in plans)
