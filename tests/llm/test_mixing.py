import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqloom.llm import mixing


def plain_targets(sizes):
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def check(docs, near):
    got = mixing.query(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.query(docs).collect()))
    source = defaultdict(list)
    for r in docs.collect():
        source[r.doc_id].append(r.source)
    size = Counter()
    for r in docs.collect():
        size[r.source] += len((r.text or "").translate({c: " " for c in range(9, 14)}).split(" ")) - (r.text or "").translate({c: " " for c in range(9, 14)}).split(" ").count("")
    goal, taken = plain_targets(size), Counter()
    for r in got:
        (s,) = set(source[r.doc_id])
        assert r.source_size == size[s] and r.target == pytest.approx(goal[s])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[s] += r.taken
    for s in size:
        assert abs(taken[s] - goal[s]) <= near(goal[s]), (s, taken[s], goal[s])


def test_small(small):
    check(small, lambda t: 0.01 * t + 5)


def test_odd(odd):
    check(odd.where("doc_id is not null"), lambda t: 0.1 * t + 30)
    assert mixing.query(odd).count() == odd.count()


def test_repeated_rows_come_out(odd):
    rows = odd.where("doc_id > 99")
    want = Counter({r.doc_id: r.copies for r in mixing.query(rows).collect() if r.copies})
    out = mixing.mixed(rows)
    assert out.columns == odd.columns and Counter(r.doc_id for r in out.collect()) == want


def test_rates_are_the_convex_optimum(spark):
    rng = random.Random(8)
    sizes = {s: [rng.choice([1, 5, 40, 300, 2500]) * rng.randrange(1, 9) for _ in range(n)] for s, n in (("a", 400), ("b", 50), (None, 900))}
    rows = spark.createDataFrame([(s, z) for s, own in sizes.items() for z in own], "source string, size long")
    totals = {s: (sum(own), len(own)) for s, own in sizes.items()}
    goal = {"a": 2.4 * sum(sizes["a"]), "b": 0.3 * sum(sizes["b"]), None: 1.1 * sum(sizes[None])}
    tilt = mixing.multipliers(rows.groupBy("source", "size").agg(F.count("*").alias("n")), totals, goal)
    for s, own in sizes.items():
        rate = lambda a: [min(3.0, math.exp(min(a * z, 60))) for z in own]  # noqa: E731, B023
        assert sum(r * z for r, z in zip(rate(tilt[s]), own, strict=True)) == pytest.approx(goal[s], rel=1e-5)
        # No exchange of tokens between two documents lowers the relative entropy: at the optimum ln r / size is one number below the cap.
        inner = [math.log(r) / z for r, z in zip(rate(tilt[s]), own, strict=True) if r < 3]
        assert max(inner) == pytest.approx(min(inner), rel=1e-6)


def test_clashing_names(small):
    names = ["tilt", "offset", "copies", "more", "source_size", "target", "size", "row", "col", "s", "n", "draw", "rate"]
    other = small.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    out = mixing.mixed(other)
    assert out.columns == other.columns
    assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in mixing.mixed(small).collect())
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")


def test_empty(empty):
    assert mixing.query(empty).collect() == []
    assert mixing.mixed(empty).collect() == []
