import random

import pytest

from seqloom.operators import graphs as gr
from seqloom.operators import hits as ht
from seqloom.operators import kernels as ke


def random_hits(rng, n):
    out = []
    for _ in range(n):
        a, b, k = rng.randrange(1, 200), rng.randrange(1, 200), rng.randrange(1, 40)
        out.append((a, a + k, b, b + k))
    return out


def test_cleaned_hits_do_not_overlap():
    rng = random.Random(1)
    for _ in range(100):
        out = ke.cleaned(random_hits(rng, rng.randrange(12)))
        for axis in (0, 2):
            own = sorted((h[axis], h[axis + 1]) for h in out)
            assert all(a[1] < b[0] for a, b in zip(own, own[1:], strict=False))
        assert ke.cleaned(out) == sorted(out)


def test_shortest_chain_is_best():
    rng = random.Random(2)
    from itertools import combinations

    for _ in range(60):
        hits = sorted(set(random_hits(rng, 6)), key=ke.middle)
        lo, hi = (min(h[0] for h in hits), min(h[2] for h in hits)), (max(h[1] for h in hits), max(h[3] for h in hits))

        def cost(chain, lo=lo, hi=hi):
            total = max(chain[0][0] - lo[0] + chain[0][2] - lo[1], 1) + max(hi[0] - chain[-1][1] + hi[1] - chain[-1][3], 1)
            return total + sum(ke.gap_cost(a, b) for a, b in zip(chain, chain[1:], strict=False))

        best = min(cost(c) for n in range(1, 7) for c in combinations(hits, n))
        assert cost(ke.shortest(hits)) == best


def test_greedy():
    assert ke.greedy([(1, 10, 1, 10), (2, 9, 30, 37), (11, 20, 5, 14), (11, 20, 11, 20)]) == [(1, 10, 1, 10), (11, 20, 11, 20)]


def test_gap_cost():
    assert ke.gap_cost((1, 10, 1, 10), (15, 20, 13, 18)) == 5 + 3
    assert ke.gap_cost((1, 10, 1, 10), (10, 20, 10, 20)) == 1
    assert ke.gap_cost((1, 11, 1, 11), (8, 18, 31, 41)) == 20 - 3
    assert ke.gap_cost((1, 11, 1, 11), (5, 15, 31, 41)) == float("inf")  # over half of it overlaps
    assert ke.gap_cost((1, 10, 50, 60), (15, 20, 13, 18)) == float("inf")


def plain_excluded(members, most):
    """By painted positions: what meets is what shares a painted run."""

    def runs(rows):
        cells = {x for b, e in rows for x in range(b, e + 1)}
        return [(b, min(x for x in range(b, max(cells) + 2) if x not in cells) - 1) for b in sorted(cells) if b - 1 not in cells]

    rest, taken = sorted(members, key=lambda m: (-(m[1] - m[0]), m)), []
    while True:
        taken.append(rest.pop(0))
        if all(e - b + 1 < most for b, e in runs(rest) if rest):
            break
    boxes, out = [list(x) for x in merged_by_touch(rest)], []
    for b, e in taken:
        hit = [x for x in boxes if set(range(x[0], x[1] + 1)) & set(range(b, e + 1))]
        if len(hit) == 0:
            boxes.append([b, e])
        elif len(hit) == 1 and len(range(min(b, hit[0][0]), max(e, hit[0][1]) + 1)) < most:
            hit[0][0], hit[0][1] = min(b, hit[0][0]), max(e, hit[0][1])
        else:
            out.append((b, e))
    return sorted(out)


def merged_by_touch(rows):
    groups = [set(range(b, e + 1)) for b, e in rows]
    while any(x & y for i, x in enumerate(groups) for y in groups[i + 1 :]):
        x = next(x for i, x in enumerate(groups) if any(x & y for y in groups[i + 1 :]))
        groups.remove(x)
        y = next(y for y in groups if x & y)
        y |= x
    return [(min(g), max(g)) for g in groups]


def test_excluded_by_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        members = sorted({(b := rng.randrange(60), b + rng.randrange(12)) for _ in range(14)})
        assert all(e - b + 1 < 15 for b, e in members)
        # Adjacent runs of painted positions that share none are groups of their own, so place members apart by doubling.
        spread = [(2 * b, 2 * e) for b, e in members]
        assert ke.excluded(spread, 30) == plain_excluded(spread, 30)
    assert ke.excluded([(1, 20), (30, 32), (31, 34)], 15) == []


def plain_chains(rows, q_len, coverage, similarity):
    """The rule step by step over a table: one list of rows, neighbours looked at in every pass."""
    rows = sorted(rows, key=lambda r: (r[2], -r[3], r[0], r[1]))
    if len(rows) < 2:
        return []
    while True:
        nested = {i for i in range(1, len(rows)) if rows[i][0] >= rows[i - 1][0] and rows[i][1] <= rows[i - 1][1] and rows[i][2] >= rows[i - 1][2] and rows[i][3] <= rows[i - 1][3]}
        if not nested:
            break
        rows = [r for i, r in enumerate(rows) if i not in nested]
    number, chains = 0, {}
    for i, r in enumerate(rows):
        if i:
            p = rows[i - 1]
            number += int(r[2] - p[3] - 1 > q_len * (1 - coverage) or r[1] < p[0] or (r[0] < p[0] and r[1] < p[1]))
        chains.setdefault(number, []).append(r)
    out = []
    for own in chains.values():
        if len(own) == 1:
            continue
        own = sorted(own, key=lambda r: (r[0], -r[1], r[2], r[3]))
        while True:
            nested = {i for i in range(1, len(own)) if own[i][0] >= own[i - 1][0] and own[i][1] <= own[i - 1][1]}
            if not nested:
                break
            own = [r for i, r in enumerate(own) if i not in nested]
        cover = [r[1] - r[0] + 1 for r in own]
        for i in range(len(own) - 1):
            cover[i] += min(0, own[i + 1][0] - own[i][1] - 1)
        ident = sum(r[4] / 100 * c for r, c in zip(own, cover, strict=True)) / sum(cover) * 100
        lo, hi = min(r[2] for r in own), max(r[3] for r in own)
        if sum(cover) / q_len > coverage and ident > similarity * 100 and (hi - lo + 1) / q_len > coverage and q_len / (hi - lo + 1) > coverage:
            out.append((min(r[0] for r in own), max(r[1] for r in own), lo, hi, ident, sum(cover)))
    return out


def test_chains_by_brute_force():
    rng = random.Random(9)
    some = 0
    for _ in range(4000):
        rows = [(a, a + k, c := max(1, a + rng.randrange(-15, 30)), c + k + rng.randrange(-3, 4), float(rng.randrange(70, 100))) for a, k in ((rng.randrange(1, 80), rng.randrange(5, 40)) for _ in range(rng.randrange(7)))]
        got, want = ht.chain_pair(rows, 80, 0.5, 0.8), plain_chains(rows, 80, 0.5, 0.8)
        some += len(want)
        assert len(got) == len(want)
        assert all(g[:4] == w[:4] and g[5] == w[5] and abs(g[4] - w[4]) < 1e-9 for g, w in zip(got, want, strict=True))
    assert some > 200
    assert ht.chain_pair([(40, 80, 1, 41, 95.0), (20, 60, 42, 82, 95.0)], 80, 0.6, 0.8) == []


def test_numbers_of_rows(spark):
    from seqloom.plans.groups import row_numbers

    df = spark.range(1000).selectExpr("(id * 7919) % 1009 AS v").repartition(6)
    got = [(r.v, r.n) for r in row_numbers(df, ["v"], "n").orderBy("v").collect()]
    assert [n for _, n in got] == list(range(1, 1001))


def plain_score(a, b):
    from functools import cache

    @cache
    def best(i, j, k):
        if i == 0 and j == 0:
            return 0 if k == 0 else -(10**9)
        out = -(10**9)
        if k == 0 and i and j:
            out = max(best(i - 1, j - 1, t) for t in range(3)) + (1 if a[i - 1] == b[j - 1] else -1)
        if k == 1 and i:
            out = max(best(i - 1, j, t) - (2 if t == 1 else 7) for t in range(3))
        if k == 2 and j:
            out = max(best(i, j - 1, t) - (2 if t == 2 else 7) for t in range(3))
        return out

    return max(best(len(a), len(b), k) for k in range(3))


def test_pairwise_alignment():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ("".join(rng.choice("ACGT") for _ in range(rng.randrange(9))) for _ in range(2))
        x, y, s = ke.align(a, b)
        assert x.replace("-", "") == a and y.replace("-", "") == b and len(x) == len(y)
        assert ("-", "-") not in set(zip(x, y, strict=True))
        if a or b:
            assert s == plain_score(a, b)


def test_star_alignment():
    rng = random.Random(5)
    seqs = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(14))) for _ in range(6)] + ["", "ACGT"]
    out = ke.star(seqs)
    assert [s.replace("-", "") for s in out] == seqs and len({len(s) for s in out}) == 1


def test_masks_and_runs():
    assert ke.unaligned(["AAAA-CCC", "AAAA-CCC", "AAAA-GTG"], 0.2) == ["AAAA----", "AAAA----", "AAAA-GTG"]
    assert ke.unaligned([]) == []
    assert ke.best_runs([1, 1, 1, 2, 1, 1, 3, 3, 3], 2) == [(1, 6, 1), (7, 9, 3)]
    assert ke.best_runs([], 3) == []


def test_chains():
    whole = ht.chain_pair([(1, 50, 1, 50, 90.0), (51, 100, 51, 100, 95.0)], 100, 0.8, 0.8)
    assert whole == [(1, 100, 1, 100, 92.5, 100)]
    assert ht.chain_pair([(1, 50, 1, 50, 90.0)], 100, 0.8, 0.8) == []
    assert ht.chain_pair([(1, 50, 1, 50, 90.0), (51, 100, 351, 400, 95.0)], 100, 0.8, 0.8) == []
    with pytest.raises(ValueError):
        ht.cutoff_share(5)


def test_tarjan():
    rng = random.Random(7)
    for _ in range(50):
        edges = [(rng.randrange(9), rng.randrange(9)) for _ in range(14)]
        reach = {v: {v} for e in edges for v in e}
        for _ in range(9):
            for a, b in edges:
                for own in reach.values():
                    if a in own:
                        own.add(b)
        assert gr.tarjan(edges) == {v: min(w for w in reach[v] if v in reach[w]) for v in reach}


def test_graphs(spark):
    e = lambda *p: spark.createDataFrame(list(p), "src long, dst long")
    g = e((1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (5, 6))
    assert {tuple(r) for r in gr.strong_components(g).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6)}
    assert {tuple(r) for r in gr.strong_components_by_colour(g).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6)}
    assert {tuple(r) for r in gr.strong_components(g, 2).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6)}
    assert {tuple(r) for r in gr.bridges(e((1, 2), (2, 3), (3, 1), (3, 4))).collect()} == {(3, 4)}
    assert {tuple(r) for r in gr.peeled(e((1, 2), (2, 3), (3, 1), (3, 4), (4, 5))).collect()} == {(1, 2, 0), (2, 3, 0), (3, 1, 0), (3, 4, 2), (4, 5, 1)}
    known = spark.createDataFrame([(1, 9), (2, 9)], "node long, component long")
    assert {tuple(r) for r in gr.attributed(e((1, 2), (3, 1), (3, 2), (4, 3), (4, 7)), known, 0.6).collect()} == {(1, 9), (2, 9), (3, 9)}
    assert gr.strong_components(e((1, 2)).limit(0)).count() == 0


def test_hits_of_null_names_and_repeats(spark):
    schema = "q_id long, s_id long, q_beg long, q_end long, s_beg long, s_end long"
    far = (1 << 60) + 1  # no float holds it
    rows = [(None, 1, 1, 100, 1, 100), (None, 1, 1, 100, 1, 100), (None, 1, 11, 30, 11, 30), (far, 1, 5, 9, 9, 5), (0, 1, 11, 30, 11, 30)]
    df = spark.createDataFrame(rows, schema)
    for find in (ke.clean_overlaps, ke.greedy_chains, ke.shortest_chains):
        got = sorted(map(tuple, find(df).collect()), key=str)
        assert got == [(0, 1, "+", 11, 30, 11, 30), (far, 1, "-", 5, 9, 9, 5), (None, 1, "+", 1, 100, 1, 100)]
        assert find(df.where("q_id < 0")).collect() == []
