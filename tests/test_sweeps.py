from pyspark.sql import functions as F

from seqloom.operators import intervals as iv
from seqloom.plans import fixtures as fx
from seqloom.plans import scan as sc


def test_sweeps_over_many_ranges(spark, monkeypatch):
    """Depth, intersections and neighbours are dealt to ranges of a key, and give what one range gives."""
    one = fx.intervals(spark, "/root/testdata/sf0.001").select((F.col("key") % 2).alias("key"), "beg", "end")
    points = spark.range(300).select((F.col("id") % 3).alias("key"), (F.col("id") * 2).alias("at"))
    made = {"depth": lambda: iv.depth(one, ["key"]), "both": lambda: iv.intersection(one.where("beg % 2 = 0"), one.where("beg % 2 = 1"), ["key"]), "near": lambda: iv.nearest(points, iv.merged(one, ["key"]), ["key"])}
    for name, make in made.items():
        whole = sorted(map(str, make().collect()))
        scans, init = [], sc.Scan.__init__
        monkeypatch.setattr(sc, "SMALL", 0)
        monkeypatch.setattr(sc, "ROWS", 0)
        monkeypatch.setattr(sc.Scan, "__init__", lambda self, *a, **k: (init(self, *a, **k), scans.append(set(map(str, self.order))))[0])
        assert sorted(map(str, make().collect())) == whole and whole, name
        assert any("at" in c for order in scans for c in order), name
        monkeypatch.undo()
