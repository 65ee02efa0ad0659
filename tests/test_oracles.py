"""Every query with SQL gives the same rows as DuckDB on the smallest tables; all others run."""

import math
import os

import duckdb
import pytest

from seqloom import catalogue, catalogue_files, catalogue_genomes  # noqa: F401

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{D}/{f}'")
    return con


def shape(rows, at):
    fix = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(fix(r[i]) for i in at) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, D)
    got = df.collect()
    if name not in catalogue.ORACLES:
        return
    found = duck.execute(catalogue.ORACLES[name])
    cols = [c[0] for c in found.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    assert shape(got, [df.columns.index(c) for c in order]) == shape(found.fetchall(), [cols.index(c) for c in order])
