import random

import pytest

from seqloom.operators import loci
from seqloom.plans import dealing


@pytest.mark.parametrize("costs", [[1000, *range(200)], [5] * 40, [10**6] * 3 + [1] * 200, [0, 0, None, -4]])
def test_tasks_hold_twice_the_mean_or_one_item(spark, costs):
    items = spark.createDataFrame(list(enumerate(costs)), "id long, c long")
    got = dealing.by_cost(items, "c", 8, ["id"]).collect()
    assert sorted(r.id for r in got) == list(range(len(costs)))
    held = {}
    for r in got:
        held.setdefault(r.task, []).append(r.cost)
    assert set(held) <= set(range(8))
    mean = sum(max(c or 0, 0) for c in costs) / 8
    for own in held.values():
        assert sum(own) <= 2 * mean or sum(c > 0 for c in own) == 1


def test_nothing_to_deal(spark):
    assert dealing.by_cost(spark.createDataFrame([], "id long, c long"), "c", 4, ["id"]).collect() == []


def mutated(rng, s):
    return "".join(rng.choice("ACGT") if rng.random() < 0.03 else c for c in s if rng.random() > 0.02)


def test_loci(spark):
    rng = random.Random(2)
    random_seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    base = random_seq(300)
    rows = [(1, i, mutated(rng, base)) for i in range(12)] + [(1, 12, None), (1, 13, "")]
    rows += [(i, r, "ACGTACGTAA"[: 6 + r]) for i in range(10, 60) for r in range(3)]  # small loci
    rows += [(2, 0, random_seq(60)), (2, 1, random_seq(60)), (3, 0, "A" * 501), (3, 1, "A"), (None, 0, "ACGT"), (None, 0, "ACGT"), (4, 0, None), (4, 1, ""), (5, 7, "ACGT"), (5, 7, "ACGT")]
    df = spark.createDataFrame(rows, "id long, row long, seq string")
    got = loci.aligned_loci(df, 4, longest=500).collect()
    assert sorted((r.id or -1, r.row, r.aligned.replace("-", "")) for r in got) == sorted((i or -1, n, s or "") for i, n, s in rows)
    status = {r.id: r.status for r in got}
    assert status[2] == "bad" and status[3] == "long" and status[None] == "unnamed" and status[4] == status[5] == "ok"
    for i, s in status.items():
        if s == "ok":
            assert len({len(r.aligned) for r in got if r.id == i}) == 1
    assert all(status[i] == "ok" for i in range(10, 60))
    assert loci.aligned_loci(df.where("id < 0"), 4).collect() == []


def plain_mixed(rows, cutoff):
    mixed = [len({r[i] for r in rows} - {"-"}) != 1 for i in range(len(rows[0]))]
    for r in rows:
        run = []
        for c, m in zip(r + "-", [*mixed, False], strict=True):
            if c != "-":
                run.append(m)
            elif run:
                if sum(run) > cutoff * len(run):
                    return True
                run = []
    return False


def test_mixed_rows():
    rng, seen = random.Random(4), set()
    for _ in range(300):
        width = rng.randrange(1, 12)
        rows = ["".join(rng.choice("AAAAAC-") for _ in range(width)) for _ in range(rng.randrange(1, 4))]
        seen.add(plain_mixed(rows, 0.2))
        assert loci.mixed_rows(rows, 0.2) == plain_mixed(rows, 0.2)
    assert seen == {True, False}
