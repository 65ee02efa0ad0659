import math

import numpy as np
import pytest

from seqloom.llm import topk


def plain(rows, every, k):
    ok = [(i, [math.floor(256 * x) for x in map(float, v)]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q and len(w) == len(v))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])}
    return out


def make(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(700, 16)) * 0.2
    base[300:420] = base[300]
    base[420:440] = 0
    rows = [(i * 5, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(base)]
    rows += [(10_000, None, 1), (10_050, [], 1), (10_100, [1.0, None], 1), (10_150, [float("nan")] * 16, 1), (10_200, [float("inf")] * 16, 1), (None, rows[0][1], 1), (10_250, [0.5, -0.5], 1), (10_251, [0.25, 1.0], None)]
    for group, block in ((None, 512), (100, 10), (30, 3)):
        got = {tuple(r) for r in topk.search(make(spark, rows), group=group, block=block).collect()}
        assert got == plain([r[:2] for r in rows], 50, 5)


def clustered(rng, n, clusters, dim=12):
    centres = rng.normal(size=(clusters, dim)) * 40
    return np.floor(centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * 2).astype(np.int64)


def test_the_tree_computes_few_distances():
    rng = np.random.default_rng(2)
    vectors = clustered(rng, 6000, 60)
    ids = np.arange(6000)
    tree = topk.Tree(ids, vectors, page=32, fan=8)
    depth, node = 1, tree.root
    while isinstance(node, topk.Inner):
        depth, node = depth + 1, node.children[0]
    assert depth >= 3
    for q in range(0, 6000, 60):
        scores = vectors @ vectors[q]
        want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if i != q))[:5]
        assert tree.search(vectors[q], q, 5) == [(-s, i) for s, i in want]
        floor = -want[2][0]
        assert [x for x in tree.search(vectors[q], q, 5, floor) if x[0] >= floor] == [(-s, i) for s, i in want if -s >= floor]
    assert tree.computed < 200 * 6000 / 5


def test_every_page_covers_its_points():
    rng = np.random.default_rng(4)
    tree = topk.Tree(np.arange(3000), np.vstack((clustered(rng, 2000, 9), np.tile(clustered(rng, 1, 1), (1000, 1)))), page=16, fan=4)

    def below(node):
        return node.rows.tolist() if isinstance(node, topk.Leaf) else [r for c in node.children for r in below(c)]

    def check(node, route):
        assert np.allclose(node.apart, np.linalg.norm(tree.points[node.rows] - route, axis=1))
        if isinstance(node, topk.Inner):
            for i, c in enumerate(node.children):
                assert np.linalg.norm(tree.points[below(c)] - node.points[i], axis=1).max() <= node.radii[i] + 1e-9
                check(c, node.points[i])

    check(tree.root, tree.route)
    assert sorted(below(tree.root)) == list(range(3000))


def test_groups_are_left_out(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) / 256 for x in v]) for i, v in enumerate(clustered(rng, 3000, 30))]
    seen = []
    real = topk._visited
    monkeypatch.setattr(topk, "_visited", lambda points, asked, *rest: (seen.append(asked.count()), real(points, asked, *rest))[1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.search(df, group=100).collect()}
    assert got == plain(rows, 50, 5)
    assert seen[0] == 60 and seen[1] < 60 * 30 / 3


def test_large_components(spark):
    rows = [(50, [3e6, -1e6]), (51, [2e6, 1.0]), (52, [1e6, 2.0]), (100, [1.5, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.search(df).collect()} == plain(rows, 50, 5)
    over = spark.createDataFrame([(50, [1e20]), (51, [1.0]), (100, [1e20])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit into 64 bits"):
        topk.search(over).collect()


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = topk.query(spark, "/root/testdata/sf0.001").collect()
    assert {tuple(r) for r in got} == plain([(r.vec_id, r.embedding) for r in df.collect()], 50, 5)
    assert topk.search(df.limit(0)).collect() == []
    few = {tuple(r) for r in topk.search(df.where("vec_id < 3")).collect()}
    assert len(few) == 2
