"""Tables behind plots, long frames and rows within blocks on small inputs with nulls, empty tables and ties."""

import math

import pytest
from seqloom.operators import coordinates as co
from seqloom.operators import orfs as of
from seqloom.plans import tables as tb

CELLS = "row string, col long, value double"


def cells(df):
    return {(r.row, r.col): (r.value, r.label) for r in df.collect()}


def test_heat(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 6.0), ("a", 3, 3.0), ("b", 1, 5.0), (None, 1, 1.0), (None, 2, None), (None, 3, 3.0)], CELLS)
    got = cells(tb.heat(df, "row"))
    assert got[("a", 1)] == (0.0, 2.0) and got[("a", 2)] == (1.0, 6.0) and got[("a", 3)] == (0.25, 3.0)
    assert got[("b", 1)] == (None, 5.0)
    assert got[(None, 1)] == (0.0, 1.0) and got[(None, 2)] == (None, None) and got[(None, 3)] == (1.0, 3.0)
    assert cells(tb.heat(df, "col"))[("b", 1)] == (1.0, 5.0)
    assert cells(tb.heat(df, binary=True))[("a", 2)] == (1.0, 6.0)
    assert tb.heat(df.limit(0), "col").count() == 0
    with pytest.raises(ValueError):
        tb.heat(df, "both")


def test_heat_leaves_nan_out_of_the_scale(spark):
    got = cells(tb.heat(spark.createDataFrame([("a", 1, 1.0), ("a", 2, float("nan")), ("a", 3, 3.0)], CELLS), "row"))
    assert got[("a", 1)][0] == 0.0 and got[("a", 3)][0] == 1.0 and math.isnan(got[("a", 2)][0])


def test_patterns(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (None, 0), (None, 0), (0, 1)], "x int, y int")
    assert {tuple(r) for r in tb.patterns(df, ["x", "y"]).collect()} == {(1, 0, 2), (None, 0, 2), (0, 1, 1)}


def test_long_frames(spark):
    df = spark.createDataFrame([(1, "GCA" * 10), (2, None), (3, "")], "name long, seq string")
    plus = [r.orf for r in of.at_least(df, 10).where("orf like '%|+|%' and aa = 'AAAAAAAAAA'").collect()]
    assert plus == ["1|ORF|1|30|+|aaLEN10"]
    assert of.at_least(df, 10, True).count() == 0


def test_spans_within_blocks(spark):
    aln = spark.createDataFrame([(1, 1, p, o) for p, o in [(1, 1), (2, 2), (3, 3), (5, -6), (6, -5), (8, 7)]], "chr long, acc long, pan long, own long")
    items = spark.createDataFrame(
        [(1, 1, 1, 3, "in"), (1, 1, 1, 3, "in"), (1, 1, 2, 5, "across"), (1, 1, 4, 5, "outside"), (1, 1, 5, 6, "back"), (2, 1, 1, 3, "other"), (1, 1, None, 3, "null")],
        "chr long, acc long, beg long, end long, tag string",
    )
    assert sorted(r.tag for r in co.within_blocks(items, aln).collect()) == ["back", "in", "in"]
