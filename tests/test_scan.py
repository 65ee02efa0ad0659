import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import annotations as an
from seqloom.operators import coordinates as co
from seqloom.operators import intervals as iv
from seqloom.operators import variants as va
from seqloom.plans import fixtures as fx
from seqloom.plans import scan as sc

SMALLEST = "/root/testdata/sf0.001"


@pytest.mark.parametrize("split", [True, False, None])
def test_columns(spark, split):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), at, rng.choice([None, 1, 2, 5])) for at in rng.sample(range(1000), 300)] + [("one", 5, None)]
    df = spark.createDataFrame(rows, "key string, at long, v long").repartition(4)
    s = sc.Scan(df, ["key"], ["at"], split).number("n").running("total", "v").reach("high", "v").before(was="v", last="at").after(next="v").last("known", "v").next("coming", "v")
    assert s.split == bool(split)
    got = {(r.key, r["at"]): r for r in s.table.collect()}
    assert s.table.columns == ["key", "at", "v", "n", "total", "high", "was", "last", "next", "known", "coming"] and len(got) == len(rows)
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        for k, (_, at, v) in enumerate(own):
            r = got[key, at]
            earlier = [x[2] for x in own[:k] if x[2] is not None]
            assert (r.n, r.total, r.high) == (k + 1, sum(earlier) + (v or 0), max(earlier, default=None))
            later = [x[2] for x in own[k + 1 :] if x[2] is not None]
            assert (r.known, r.coming) == (earlier[-1] if earlier else None, later[0] if later else None)
            assert (r.was, r["last"]) == ((own[k - 1][2], own[k - 1][1]) if k else (None, None)) and r.next == (own[k + 1][2] if k + 1 < len(own) else None)
    assert sc.Scan(df.limit(0), ["key"], ["at"], split).number("n").table.collect() == []


def test_many_ranges_give_what_one_gives(spark, monkeypatch):
    """Blocks, breaks, variants and groups are the same with one range a key and with many, however long an axis is."""
    pos = fx.positions(spark, SMALLEST)
    items = fx.intervals(spark, SMALLEST).select((F.col("key") % 2).alias("chr"), F.when(F.col("beg") % 2 == 0, "+").otherwise("-").alias("strand"), "beg", "end").distinct()
    genes = pos.where("acc = 1").select("chr", F.col("pan").alias("id"), F.abs("own").alias("beg"), (F.abs("own") + 3).alias("end"), F.lit("+").alias("strand"))
    made = {
        "merged": lambda: co.merged_blocks(pos, 20), "breaks": lambda: co.breaks(pos), "nearest": lambda: co.lift(genes, pos, 1, 2, False), "classes": lambda: va.sv_classes(va.sv_genotypes(pos), 8),
        "grouped": lambda: an.grouped(items), "union": lambda: iv.merged(items, ["chr"]), "moved": lambda: co.translocated(pos.where("acc = 1").select("chr", "pan", (F.col("own") % 5).alias("id"))),
    }
    for name, make in made.items():
        one = sorted(map(str, make().collect()))
        monkeypatch.setattr(sc, "SMALL", 0)
        monkeypatch.setattr(sc, "ROWS", 0)
        many = make()
        assert sorted(map(str, many.collect())) == one and one, name
        monkeypatch.undo()


def test_equal_rows_share_their_group(spark):
    """Rows that are equal by key and order stay in one group however a later sort turns them."""
    rows = [("a", 10 * (k // 9), 10 * (k // 9) + 3, int(k % 9 == 4)) for k in range(900)]
    df = spark.createDataFrame(rows, "key string, beg long, end long, new int").repartition(7)
    for split in (True, False):
        got = sc.Scan(df, ["key"], ["beg", "end"], split).running("g", "new", peers=True).table.groupBy("beg").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).collect()
        assert {(r.beg, r.lo, r.hi) for r in got} == {(10 * k, k + 1, k + 1) for k in range(100)}
