from collections import Counter

import duckdb
import numpy as np
import pytest

from seqloom.llm import topk


@pytest.mark.parametrize(("group", "block"), [(None, 512), (20, 2)])
def test_repeated_ids_against_sql(spark, tmp_path, group, block):
    rng = np.random.default_rng(5)
    base = [[float(np.float32(x)) for x in v] for v in rng.normal(size=(60, 8)) * 0.3]
    rows = [(i * 10, v) for i, v in enumerate(base)]
    rows += [(100, [2 * x for x in base[10]])] * 8  # own rows would fill a page's places
    rows += [(33, base[7])] * 3 + [(150, base[3]), (150, base[4])] + [(250, base[25])] * 7
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = Counter((q, n, i, int(s)) for q, n, i, s in con.execute(topk.ORACLE).fetchall())
    assert Counter(tuple(r) for r in topk.search(df, group=group, block=block).collect()) == want


def test_own_rows_do_not_hide_the_others(spark):
    rows = [(50, [1.0, 1.0])] * 9 + [(i, [i / 100, 0.5]) for i in range(1, 8)]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.vec_id for r in got} == {7} and sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5]
