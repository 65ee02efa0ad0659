import itertools
import random

import numpy as np
import pytest

from seqloom.functions import codes
from seqloom.functions.dynamic import strings, whole
from seqloom.operators import kernels as ke
from seqloom.operators import refine as rf


def plain_tree(d):
    """Merges by the rule: of all pairs of clusters the nearest by their farthest members, ties by their smallest leaves."""
    held = [([k], k) for k in range(len(d))]
    out = []
    for k in range(len(d) - 1):
        pairs = [(max(d[x, y] for x in a for y in b), min(a + b), max(min(a), min(b)), (a, m), (b, n)) for (a, m), (b, n) in itertools.combinations(held, 2)]
        height, _, _, one, two = min(pairs, key=lambda x: x[:3])
        held = [x for x in held if x not in (one, two)] + [(one[0] + two[0], len(d) + k)]
        out.append((*sorted((one[1], two[1])), height, len(one[0] + two[0])))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_trees(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 14))
    d = np.triu(rng.integers(0, 6 if seed % 2 else 1000, (n, n)).astype(float), 1)
    d = d + d.T
    merges = rf.linkage(d)
    assert merges == plain_tree(d)
    order = rf.leaves(merges)
    assert sorted(order) == list(range(n))
    for height in (-1, 2, 500, 2000):
        label = rf.cut_at(merges, height)
        # Clusters are the largest subtrees of up to that height.
        members = [[k] for k in range(n)] + [None] * len(merges)
        want = list(range(n))
        for k, (a, b, h, _) in enumerate(merges):
            members[n + k] = members[a] + members[b]
            if h <= height:
                for x in members[n + k]:
                    want[x] = min(members[n + k])
        assert label == want
        # Each cluster is a stretch of the leaf order.
        assert [c for c, _ in itertools.groupby(label[k] for k in order)] == list(dict.fromkeys(label[k] for k in order))


def test_trees_as_tables(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for aln in range(12):
        n = rng.randrange(2, 9)
        names = sorted(rng.sample(range(50), n))
        d = np.zeros((n, n))
        for a in range(n):
            for b in range(a):
                d[a, b] = d[b, a] = rng.choice([0.1, 0.2, 0.5, rng.random()])
                rows.append((aln, names[b], names[a], float(d[a, b])))
        want[aln] = (names, plain_tree(d))
    rows.append((99, 1, 2, None))
    df = spark.createDataFrame(rows, "aln long, i long, j long, d double").repartition(5)
    tree, order, cluster = rf.dendrogram(df).collect(), rf.leaf_order(df).collect(), rf.linkage_clusters(df, 0.4).collect()
    for aln, (names, merges) in want.items():
        n = len(names)
        name = lambda x: names[x] if x < n else n - x - 1  # noqa: E731, B023
        assert sorted((r.step, r.left, r.right, r.height, r.size) for r in tree if r.aln == aln) == [(k, name(a), name(b), h, s) for k, (a, b, h, s) in enumerate(merges, 1)]
        assert [r.row for r in sorted(order, key=lambda r: r.place) if r.aln == aln] == [names[k] for k in rf.leaves(merges)]
        assert [r.cluster for r in sorted(cluster, key=lambda r: r.row) if r.aln == aln] == [names[k] for k in rf.cut_at(merges, 0.4)]
    assert {r.aln for r in tree} == set(want)
    assert rf.dendrogram(df.limit(0)).collect() == [] and rf.leaf_order(df.limit(0)).collect() == []


def plain_whole(score, n, m, opening, extension):
    low = -(10**9)
    h = [[[low] * 3 for _ in range(m + 1)] for _ in range(n + 1)]
    h[0][0][0] = 0
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j:
                h[i][j][0] = max(h[i - 1][j - 1]) + score(i - 1, j - 1)
            if i:
                h[i][j][1] = max(h[i - 1][j][0] - opening, h[i - 1][j][1], h[i - 1][j][2] - opening) - extension
            if j:
                h[i][j][2] = max(h[i][j - 1][0] - opening, h[i][j - 1][1] - opening, h[i][j - 1][2]) - extension
    return max(h[n][m])


def worth(path, score, opening, extension):
    total, i, j, last = 0, 0, 0, ""
    for x in path:
        total += score(i, j) if x == "M" else -extension - (opening if x != last else 0)
        i, j, last = i + (x != "B"), j + (x != "A"), x
    return total


@pytest.mark.parametrize("seed", range(60))
def test_whole(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(0, 12, 2)
    table = rng.integers(-9, 10, (n, m)).astype(np.int64)
    opening, extension = [(3, 1), (0, 1), (10, 2)][seed % 3]
    total, path = whole(lambda i: table[i], n, m, opening, extension)
    assert path.count("A") + path.count("M") == n and path.count("B") + path.count("M") == m
    assert total == plain_whole(lambda i, j: int(table[i, j]), n, m, opening, extension) == worth(path, lambda i, j: int(table[i, j]), opening, extension)


def noisy(rng, seq, rate):
    return "".join(rng.choice("ACGT") if (x := rng.random()) < rate else "" if x < 1.5 * rate else c + rng.choice("ACGT") if x < 2 * rate else c for c in seq)


def test_merged_profiles(spark):
    rng, rows, want = random.Random(9), [], {}
    for k in range(30):
        base = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 14)))
        sides = {}
        for side in (1, 2):
            width = len(base) + rng.randrange(3)
            sides[side] = ["".join(rng.choice("ACGTN-") if rng.random() < 0.3 else c for c in base.ljust(width, "A")) for _ in range(rng.randrange(1, 4))]
            rows += [(k, side, r, s) for r, s in enumerate(sides[side])]
        want[k] = sides
    rows += [(100, 2, 0, "ACG"), (100, 2, 1, "A-G")]
    df = spark.createDataFrame(rows, "id long, side long, row long, seq string").repartition(3)
    out = rf.merged_profiles(df)
    got = {(r.id, r.side, r.row): r.aligned for r in out.collect()}
    assert got[100, 2, 0] == "ACG" and got[100, 2, 1] == "A-G"
    for k, sides in want.items():
        aligned = {s: [got[k, s, r] for r in range(len(sides[s]))] for s in (1, 2)}
        assert len({len(x) for s in (1, 2) for x in aligned[s]}) == 1
        # Columns of a side stay whole and in order: dropping those it has no part in gives it back.
        path = rf.merged(sides[1], sides[2])
        assert aligned == {1: rf.spread(sides[1], path, "A"), 2: rf.spread(sides[2], path, "B")}
        for s, gone in ((1, "B"), (2, "A")):
            assert ["".join(c for c, x in zip(row, path, strict=True) if x != gone) for row in aligned[s]] == sides[s]

        def score(i, j, one=sides[1], two=sides[2]):
            pairs = [(a[i], b[j]) for a in one for b in two]
            return int(np.rint(1000 * sum(0 if "-" in p else 1 if p[0] == p[1] != "N" else -1 for p in pairs) / len(pairs)))

        n, m = len(sides[1][0]), len(sides[2][0])
        # Means are rounded after other sums, by one at most.
        assert abs(worth(path, score, rf.OPENING, rf.EXTENSION) - plain_whole(score, n, m, rf.OPENING, rf.EXTENSION)) <= n + m
    blocks = rf.shared_blocks(out).collect()
    for r in blocks:
        assert r.beg1 <= r.end1 and r.beg2 <= r.end2 and r.length >= max(r.end1 - r.beg1, r.end2 - r.beg2) + 1


def test_runs():
    path = "MMAAMMBBBBBBMAAAAM"
    assert rf.runs(path, 1) == [(0, 2), (4, 6), (12, 13), (17, 18)]
    assert rf.runs(path, 3) == [(0, 6), (12, 13), (17, 18)]
    assert rf.runs(path, 5) == [(0, 6), (12, 18)] and rf.runs("AAA", 5) == [] and rf.runs("", 5) == []


def test_support():
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    head, tail = word(60), word(60)
    one, two = head + "A" * 40 + tail, head + "C" * 40 + tail
    path = "M" * 160
    # What agrees stays in common columns, and what does not stands side by side.
    split = rf.supported([one], [two], "M" * 60 + "A" * 10 + "M" * 30 + "B" * 10 + "M" * 60)
    assert split == "M" * 60 + "A" * 40 + "B" * 40 + "M" * 60
    assert rf.supported([one], [two], path) == "A" * 160 + "B" * 160 or rf.supported([one], [two], path) == path
    assert rf.supported([one], [one], path) == path and rf.supported([], [one], "B" * 160) == "B" * 160


def test_refined(spark):
    rng, rows, seqs = random.Random(4), [], {}
    for k in range(8):
        bases = ["".join(rng.choice("ACGT") for _ in range(120)) for _ in range(2)]
        seqs[k] = [noisy(rng, rng.choice(bases), 0.02) for _ in range(6)] + ["", bases[0]]
        rows += [(k, r, s) for r, s in enumerate(seqs[k])]
    rows += [(50, 0, None), (51, 0, "AC-GT")]
    got = {}
    for r in rf.refined_alignments(spark.createDataFrame(rows, "id long, row long, seq string")).collect():
        got.setdefault(r.id, {})[r.row] = r.aligned
    assert got[50] == {0: ""} and got[51] == {0: "ACGT"}
    for k, own in seqs.items():
        out = [got[k][r] for r in range(len(own))]
        assert [x.replace("-", "") for x in out] == own and len({len(x) for x in out}) == 1
    # Near sequences share their columns.
    a = "".join(rng.choice("ACGT") for _ in range(100))
    x, y = rf.refined([a, a[:50] + a[51:]])
    assert sum(p == q for p, q in zip(x, y, strict=True)) == 99 and len(x) == 100


def test_shared_words():
    rng = random.Random(1)
    for _ in range(30):
        seqs = ["".join(rng.choice("ACG") for _ in range(rng.randrange(0, 30))) for _ in range(rng.randrange(1, 7))]
        found = [codes.word_codes(codes.symbols(s), 3) for s in seqs]
        row = np.repeat(np.arange(len(seqs)), [len(f) for f in found])
        got = codes.shared_words(np.concatenate(found), row, len(seqs), rng.choice([1, 5, 1000]))
        words = [[s[i : i + 3] for i in range(len(s) - 2)] for s in seqs]
        want = [[sum(min(a.count(w), b.count(w)) for w in set(a)) for b in words] for a in words]
        assert got.tolist() == want


def test_star_aligns_each_once(monkeypatch):
    calls = []
    align = ke.align
    monkeypatch.setattr(ke, "align", lambda *a: calls.append(a) or align(*a))
    rng = random.Random(2)
    base = "".join(rng.choice("ACGT") for _ in range(40))
    seqs = [noisy(rng, base, 0.1) for _ in range(9)]
    out = ke.star(seqs)
    assert [s.replace("-", "") for s in out] == seqs and len(calls) == len(set(seqs)) - 1
    assert strings("AC", "C", "AM") == ("AC", "-C")
