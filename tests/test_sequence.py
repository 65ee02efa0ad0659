import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.functions import sequence as sq
from seqloom.operators import alignment as am
from seqloom.operators import runs as rn
from seqloom.operators import similarity as si


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("x")).first().x


def test_examples(spark):
    assert one(spark, sq.rev_compl, "GGATTKVN") == "NBMAATCC"
    assert one(spark, lambda s: sq.rev_compl(sq.rev_compl(s)), "tgcahbdw") == "TGCAHBDW"
    assert one(spark, sq.gc_content, "GgTACc-T") == 0.5
    assert one(spark, sq.gc_content, "") is None
    assert one(spark, lambda s: sq.words(s, 3), "TTGCA") == ["TTG", "TGC", "GCA"]
    assert one(spark, lambda s: sq.words(s, 9), "TTGCA") == []
    assert one(spark, lambda s: sq.clean(s, 1), "--GA-TC---T-") == "ATC"
    assert one(spark, sq.translate_seq, "ATGTAATTNGGGA") == "M*-G"
    assert one(spark, sq.translate_seq, "atgéééTGG") == "M-W"
    assert one(spark, lambda s: sq.field(s, 2), "k|m|n") == "m"
    assert one(spark, sq.combination_ref, "7_31") == 31 and one(spark, sq.combination_ref, "y_2") is None
    assert one(spark, sq.prefix_fields, "p_r_4_9").asDict() == {"acc": "p_r", "q": "4", "r": "9"}
    assert len(sq.masks()) == 23
    m = sq.masks()[8]
    assert one(spark, lambda s: sq.mask(sq.mask(s, m), sq.inverse_mask(m)), "GATTACAC") == "GATTACAC"


@pytest.mark.parametrize(("n", "step"), [(1, 0), (3, 0), (4, 2), (7, 3), (50, 0)])
def test_pieces_follow_the_rule(spark, n, step):
    text = "cgtaN-GGATCCATtcagg"
    assert one(spark, lambda s: sq.split_seq(s, n, step), text) == [text[i : i + n] for i in range(step, len(text), n)]


def plain_repeat_score(text, size, cutoff):
    found = Counter(text[i : i + size] for i in range(len(text) - size + 1))
    return sum(v for v in found.values() if v > cutoff) / sum(found.values()) if found else None


def test_repeat_score(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("A", "AC", "ACGT", "ACGTNRYKMBDHVSWx-") for n in (0, 1, 9, 10, 11, 12, 60, 300)]
    texts += [t * 4 for t in texts]
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    for size, cutoff in ((11, 2), (3, 1), (20, 1)):
        for r in rows.select("s", sq.repeat_score(F.col("s"), size, cutoff).alias("x")).collect():
            want = plain_repeat_score(r.s, size, cutoff)
            assert r.x == want if want is None else r.x == pytest.approx(want)


def test_symbols(spark):
    assert one(spark, sq.single_symbols, "GAT") == ["G", "A", "T"] and one(spark, sq.single_symbols, "") == []
    assert one(spark, lambda s: sq.checked_symbols(sq.single_symbols(s)), "GAT") == ["G", "A", "T"]
    with pytest.raises(Exception, match="single symbol"):
        one(spark, lambda s: sq.checked_symbols(F.array(s)), "GAT")


@pytest.mark.parametrize("bad", ["ACX", "A-C"])
def test_unknown_symbols_raise(spark, bad):
    with pytest.raises(Exception, match="unknown symbol"):
        one(spark, sq.complement, bad)


def rows(spark, *seqs):
    return spark.createDataFrame([(1, i, s) for i, s in enumerate(seqs)], "aln long, row long, seq string")


def test_alignment_examples(spark):
    a = rows(spark, "ATG-C", "ATGGC", "ACG-C")
    cells = am.to_cells(a)
    assert "".join(r.nt for r in am.consensus(a).orderBy("col").collect()) == "ATGGC"
    p = {r.col: (r.a, r.c, r.g, r.t, r.gap) for r in am.profile(a).collect()}
    assert sorted(map(tuple, am.profile(a).collect())) == sorted(map(tuple, am.profile_of_cells(cells).collect()))
    assert [p[i] for i in range(1, 6)] == [(3, 0, 0, 0, 0), (0, 1, 0, 2, 0), (0, 0, 3, 0, 0), (0, 0, 1, 0, 2), (0, 3, 0, 0, 0)]
    got = [r.pos for r in am.positions(rows(spark, "ATG-C", "A-GGC", "---", "A-T-G-")).orderBy("row").collect()]
    assert got == [[1, 2, 3, 0, 4], [1, 0, 2, 3, 4], [0, 0, 0], [1, 0, 2, 0, 3, 0]]
    flat = {(r["row"], r.col): r.pos for r in am.positions_of_cells(am.to_cells(rows(spark, "A-TGC")), 1).collect()}
    assert [flat[0, c] for c in range(1, 6)] == [0, 0, 1, 2, 0]
    assert [r.seq for r in am.to_strings(cells).orderBy("row").collect()] == ["ATG-C", "ATGGC", "ACG-C"]
    assert am.check_equal_lengths(rows(spark, "AC", "ACG")).count() == 1
    gap = rows(spark, "-", "-")
    assert am.consensus(gap).first().nt == "A" and am.consensus(gap, "N").first().nt == "N"
    assert [r.diff for r in am.difference(rows(spark, "A-G", "AC-")).orderBy("row").collect()] == ["sgs", "ssg"]


def test_blocks_of_columns_and_rows(spark):
    rng = random.Random(3)
    data = [(a, i, "".join(rng.choice("ACGTacN-") for _ in range(40))) for a in (1, 2) for i in range(23)]
    df = spark.createDataFrame(data, "aln long, row long, seq string").repartition(4)
    want = sorted(map(tuple, am.profile_of_cells(am.to_cells(df)).collect()))
    assert sorted(map(tuple, am.column_counts(df, 7).drop("n").collect())) == want
    by = {(a, i): s for a, i, s in data}
    pairs = {(r.aln, r.i, r.j): (r.same, r.both, r.either, r.n_i, r.n_j) for r in am.pair_counts(df, size=4).collect()}
    assert len(pairs) == am.pair_counts(df, size=4).count() == 2 * 23 * 22 // 2
    for (a, i, j), got in pairs.items():
        z = list(zip(by[a, i], by[a, j], strict=True))
        p, q = [x != "-" for x, _ in z], [y != "-" for _, y in z]
        same = sum(x == y != "-" for x, y in z)
        assert i < j and got == (same, sum(u and v for u, v in zip(p, q, strict=True)), sum(u or v for u, v in zip(p, q, strict=True)), sum(p), sum(q))


def test_windows():
    rng = random.Random(4)
    for n, m in ((0, 5), (6, 5), (40, 33)):
        a, b = ("".join(rng.choice("ACG") for _ in range(k)) for k in (n, m))
        want = sorted((i + 1, j + 1, k) for i in range(n - 5) for j in range(m - 5) if (k := sum(x == y for x, y in zip(a[i : i + 6], b[j : j + 6], strict=True))) >= 4)
        for rows_ in (1, 7, 4096):
            assert sorted(zip(*(c.tolist() for c in codes.windows(a, b, 6, 4, rows_)), strict=True)) == want


def test_running_positions():
    assert codes.running("", 0) == [] and codes.running("--A-", 1) == [0, 0, 0, 0]
    assert np.array_equal(codes.running("A-CG-T", 1), [0, 0, 1, 2, 0, 0])


def test_bad_alignments(spark):
    rows_ = [(1, 0, "ACGT--AC"), (1, 1, "ACGA--AC"), (2, 0, "TTTT"), (2, 1, "AAAA"), (3, 0, "--"), (3, 1, "--"), (4, 0, "AC"), (4, 1, "--")]
    df = spark.createDataFrame(rows_, "aln long, row long, seq string")
    assert {r.aln: r.bad for r in am.bad_alignments(df, 0.2).collect()} == {1: True, 2: True, 4: False}
    assert {r.aln: r.bad for r in am.bad_alignments(df, 0.3, 5).collect()} == {1: False, 2: False, 4: False}


def test_clusters_of_large_row_numbers(spark):
    big = 1 << 20
    df = spark.createDataFrame([(1, 5, big, 0.1), (1, big, big + 5, 0.1), (2, 0, 5, 0.1), (2, 5, 9, 0.9)], "aln long, i long, j long, d double")
    got = {(r.aln, r["row"]): r.cluster for r in si.clusters(df, 0.5).collect()}
    assert got == {(1, 5): 5, (1, big): 5, (1, big + 5): 5, (2, 0): 0, (2, 5): 0, (2, 9): 9}


def test_dots_of_a_grid_and_of_one(spark):
    seqs = spark.createDataFrame([("g", 1, "ACGTACGTAA"), ("g", 2, "TTACGTAA"), ("h", 3, "ACGTACG")], "grp string, id long, seq string")
    got = {(r.id1, r.id2, r.i, r.j, r.n) for r in si.dot_grid(seqs, 5, 5).collect()}
    assert got == {(1, 2, i, j, 5) for i, j in ((1, 3), (4, 2), (5, 3), (6, 4))}
    own = {(r.i, r.j) for r in si.self_dots(seqs.where("id = 1"), 5, 5).collect() if r.n > 0}
    assert own == {(1, 5)}


def test_runs(spark):
    f = spark.createDataFrame([(1, i, x) for i, x in enumerate([0, 1, 1, 0, 1, 0, 0, 1, 1, 1, 0], 1)], "key long, pos long, flag int")
    assert sorted((r.beg, r.end) for r in rn.runs_of_ones(f, ["key"]).collect()) == [(2, 3), (5, 5), (8, 10)]
    v = spark.createDataFrame([(1, i, x) for i, x in enumerate([1, 2, 3, 5, 6, 7, 10, 11, 12, 14], 1)], "key long, pos long, v long")
    assert sorted(r.len for r in rn.runs_of_steps(v, ["key"]).collect()) == [1, 3, 3, 3]
    with pytest.raises(Exception, match="0 or 1"):
        rn.runs_of_ones(f.withColumn("flag", F.lit(2)), ["key"]).collect()
