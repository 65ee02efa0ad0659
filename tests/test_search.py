import random

import numpy as np
import pytest

from seqloom.functions import dynamic
from seqloom.functions.dynamic import extend, strings, through
from seqloom.operators import search as se

NT = se.base_scores(1, -2)


def affine(a, b, score, opening, extension, local):
    """Best score of a plain affine table: over all pairs of places (local), or of prefixes."""
    low = -(10**9)
    h = [[0 if local or (i == 0 and j == 0) else low for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    e, f = [[low] * (len(b) + 1) for _ in h], [[low] * (len(b) + 1) for _ in h]
    best = 0
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i:
                e[i][j] = max(h[i - 1][j] - opening, e[i - 1][j]) - extension
            if j:
                f[i][j] = max(h[i][j - 1] - opening, f[i][j - 1]) - extension
            pair = h[i - 1][j - 1] + score(a[i - 1], b[j - 1]) if i and j else low
            h[i][j] = max(h[i][j], pair, e[i][j], f[i][j])
            best = max(best, h[i][j])
    return best


def scored(x, y, score, opening, extension):
    total, last = 0, ""
    for c, d in zip(x, y, strict=True):
        kind = "A" if d == "-" else "B" if c == "-" else "M"
        total += score(c, d) if kind == "M" else -extension - (opening if kind != last else 0)
        last = kind
    return total


def nt(c, d):
    return 1 if c == d and c in "ACGT" else -2


def aa(c, d):
    return int(se.AMINO_SCORES[se.RESIDUES.index(c), se.RESIDUES.index(d)])


def noisy(rng, seq, letters, rate):
    out = []
    for c in seq:
        x = rng.random()
        out.append(rng.choice(letters) if x < rate else "" if x < 1.4 * rate else c + rng.choice(letters) * rng.randrange(1, 4) if x < 1.8 * rate else c)
    return "".join(out)


def flip(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


@pytest.mark.parametrize("seed", range(60))
def test_extension(seed):
    rng = random.Random(seed)
    letters = rng.choice(["AC", "ACGT"])
    a = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 40)))
    b = noisy(rng, a, letters, 0.2) if seed % 3 else "".join(rng.choice(letters) for _ in range(rng.randrange(0, 40)))
    opening, extension = rng.choice([(10, 2), (1, 1), (0, 1), (3, 2)])
    code = lambda s: se._BASE[np.frombuffer(s.encode(), dtype=np.uint8)]
    score, i, j, path = extend(code(a), code(b), NT, opening, extension, 1000)
    x, y = strings(a[:i], b[:j], path)
    assert (x.replace("-", ""), y.replace("-", "")) == (a[:i], b[:j])
    assert score == affine(a, b, nt, opening, extension, False) == scored(x, y, nt, opening, extension)
    # A small drop gives an alignment that is worth what it says, and never more.
    less, i, j, path = extend(code(a), code(b), NT, opening, extension, 5)
    assert less <= score and less == scored(*strings(a[:i], b[:j], path), nt, opening, extension)


def planted(rng, letters, n, m, rate):
    """Targets with noisy copies of parts of the queries, some of them turned."""
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    queries = [(f"q{k}", word(rng.randrange(150, 300))) for k in range(n)]
    targets = []
    for k in range(m):
        piece = noisy(rng, queries[k % n][1][20:140], letters, rate)
        targets.append((f"s{k}", word(rng.randrange(0, 400)) + (flip(piece) if letters == "ACGT" and k % 2 else piece) + word(rng.randrange(0, 400))))
    return queries, targets


@pytest.mark.parametrize("frequent, stride", [(20_000, 1 << 15), (1, 100)])
def test_local_hits(spark, monkeypatch, frequent, stride):
    """The best hit of each planted pair is the optimum of a plain table, wherever stretches begin and however words are dealt."""
    monkeypatch.setattr(se, "FREQUENT", frequent)
    rng = random.Random(7)
    queries, targets = planted(rng, "ACGT", 5, 12, 0.03)
    q, s = spark.createDataFrame([*queries, ("none", None), ("short", "ACG")], "name string, seq string"), spark.createDataFrame([*targets, ("empty", ""), ("n", "N" * 100)], "name string, seq string")
    found = se.local_hits(q, s, 20, drop=60, stride=stride).collect()
    best = {}
    for r in found:
        mine, other = dict(queries)[r.q], dict(targets)[r.s]
        own, its = mine[r.q_beg - 1 : r.q_end], other[min(r.s_beg, r.s_end) - 1 : max(r.s_beg, r.s_end)]
        assert r.q_aln.replace("-", "") == own and r.s_aln.replace("-", "") == (its if r.strand == "+" else flip(its)) and (r.s_beg > r.s_end) == (r.strand == "-")
        assert r.score == scored(r.q_aln, r.s_aln, nt, 10, 2) and r.length == len(r.q_aln)
        assert r.identity == pytest.approx(100 * sum(c == d for c, d in zip(r.q_aln, r.s_aln, strict=True)) / r.length)
        best[r.q, r.s, r.strand] = max(best.get((r.q, r.s, r.strand), 0), r.score)
    assert len(found) == len({tuple(r)[:7] for r in found})
    for k, (name, seq) in enumerate(targets):
        q_name, q_seq = queries[k % 5]
        strand = "-" if k % 2 else "+"
        assert best[q_name, name, strand] == affine(q_seq if strand == "+" else flip(q_seq), seq, nt, 10, 2, True)
    # Every pair with an exact match of 20 has a hit.
    exact = {(n, m, d) for n, a in queries for m, b in targets for d, x in (("+", a), ("-", flip(a))) for i in range(len(x) - 19) if x[i : i + 20] in b}
    assert exact == set(best)


def test_limits_and_copies(spark):
    rng = random.Random(3)
    word = "".join(rng.choice("ACGT") for _ in range(200))
    df = spark.createDataFrame([(f"c{k}", word) for k in range(40)] + [("twice", word + "N" * 50 + word[:150])], "name string, seq string")
    found = se.local_hits(df, df, 28)
    assert found.where("strand = '+'").count() >= 41 * 41 and found.where("strand = '+' and q = 'c0' and s = 'twice'").count() == 2
    one = se.local_hits(df, df, 28, most=1, least=200, identity=100.0).collect()
    assert sorted((r.q, r.s, r.score) for r in one if "twice" not in (r.q, r.s)) == sorted((f"c{a}", f"c{b}", 200) for a in range(40) for b in range(40))
    assert se.local_hits(df.limit(0), df).collect() == [] and se.local_hits(df, df.limit(0)).collect() == []


def test_two_sequences(spark):
    rng = random.Random(5)
    queries, targets = planted(rng, "ACGT", 6, 6, 0.04)
    pairs = spark.createDataFrame([(k, queries[k][1], targets[k][1]) for k in range(6)] + [(9, None, "ACGT"), (10, "", "")], "id long, s1 string, s2 string")
    back = pairs.selectExpr("id", "s2 AS s1", "s1 AS s2")
    found, turned = se.two_sequences(pairs, 16, drop=60).collect(), se.two_sequences(back, 16, drop=60).collect()
    for k in range(6):
        strand = "-" if k % 2 else "+"
        a, b = queries[k][1], targets[k][1]
        mine = [r for r in found if r.id == k and r.strand == strand]
        assert max(r.score for r in mine) == affine(a if strand == "+" else flip(a), b, nt, 10, 2, True)
        for r in mine:
            its = b[min(r.beg2, r.end2) - 1 : max(r.beg2, r.end2)]
            assert r.beg1 <= r.end1 and r.aln1.replace("-", "") == a[r.beg1 - 1 : r.end1] and r.aln2.replace("-", "") == (its if strand == "+" else flip(its))
    # Both directions are asked, so the order of the two does not matter.
    places = lambda rows, flipped: sorted((r.id, r.strand, r.score, *((min(r.beg2, r.end2), max(r.beg2, r.end2), r.beg1, r.end1) if flipped else (min(r.beg1, r.end1), max(r.beg1, r.end1), min(r.beg2, r.end2), max(r.beg2, r.end2)))) for r in rows)
    assert places(found, False) == places(turned, True)


def test_markers():
    """Two sequences with an exact match of the window's size share a marked word within it."""
    rng = random.Random(2)
    code = lambda s: se._BASE[np.frombuffer(s.encode(), dtype=np.uint8)]
    for _ in range(200):
        letters, size = rng.choice(["ACGT", "AC", "A"]), rng.choice([16, 20, 28])
        common = "".join(rng.choice(letters) for _ in range(size))
        places = []
        for _ in range(2):
            head = "".join(rng.choice("ACGTN") for _ in range(rng.randrange(50)))
            at, word = se.markers(code(head + common + "".join(rng.choice("ACGTN") for _ in range(rng.randrange(50)))), size)
            places.append({(int(a) - len(head), int(w)) for a, w in zip(at, word, strict=True)})
        assert any(0 <= a <= size - 16 for a, _ in places[0] & places[1])


def test_neighbours():
    begin, near = se.neighbours(11)
    rng = random.Random(1)
    for _ in range(20):
        w = rng.randrange(8000)
        split = lambda v: (v // 400, v // 20 % 20, v % 20)
        want = [v for v in range(8000) if sum(int(se.AMINO_SCORES[x, y]) for x, y in zip(split(w), split(v), strict=True)) >= 11]
        assert near[begin[w] : begin[w + 1]].tolist() == want
    assert (se.AMINO_SCORES == se.AMINO_SCORES.T).all()


@pytest.mark.parametrize("residues", [1 << 17, 300])
def test_protein_hits(spark, residues):
    """Related proteins are found with the optimum of a plain table; seeds are those of the rule."""
    rng = random.Random(11)
    letters = se.RESIDUES[:20]
    queries, targets = planted(rng, letters, 4, 6, 0.25)
    q, s = spark.createDataFrame([*queries, ("none", None), ("odd", "xx*?!")], "name string, seq string"), spark.createDataFrame([*targets, ("e", "")], "name string, seq string")
    found = se.protein_hits(q, s, residues=residues, drop=200, cutoff=25).collect()
    best = {}
    for r in found:
        assert r.score == scored(r.q_aln, r.s_aln, aa, 11, 1) >= 40
        assert r.q_aln.replace("-", "") == dict(queries)[r.q][r.q_beg - 1 : r.q_end] and r.s_aln.replace("-", "") == dict(targets)[r.s][r.s_beg - 1 : r.s_end]
        best[r.q, r.s] = max(best.get((r.q, r.s), 0), r.score)
    for k, (name, seq) in enumerate(targets):
        q_name, q_seq = queries[k % 4]
        assert best[q_name, name] == affine(q_seq, seq, aa, 11, 1, True)
    block = se.ProteinBlock([n for n, _ in targets], [t for _, t in targets])
    for _, text in queries[:2]:
        a = se._RESIDUE[np.frombuffer(text.encode(), dtype=np.uint8)]
        hit = {(p, x, y) for p, c in enumerate(block.codes) for x in range(len(a) - 2) for y in range(len(c) - 2) if int(se.AMINO_SCORES[a[x : x + 3], c[y : y + 3]].sum()) >= 11}
        want = {(p, x, y) for p, x, y in hit if any((p, x - d, y - d) in hit for d in range(3, 41))}
        assert {tuple(r) for r in block.seeds(a).tolist()} == want
    assert se.protein_hits(q.limit(0), s).collect() == [] and se.protein_hits(q, s.limit(0)).collect() == []


def test_seed_alignment_is_whole():
    rng = random.Random(4)
    a = "".join(rng.choice("ACGT") for _ in range(80))
    b = a[:30] + a[33:]
    code = lambda s: se._BASE[np.frombuffer(s.encode(), dtype=np.uint8)]
    score, i, j, path = through(code(a), code(b), 0, 0, 30, NT, 10, 2, 30)
    assert (score, i, j) == (77 - 16, 0, 0) and path.count("A") == 3 and path.count("B") == 0


def test_stretches_without_gaps():
    rng = random.Random(6)
    end = np.array([len(se.RESIDUES)], dtype=np.uint8)
    for _ in range(50):
        a, b = (np.array([rng.randrange(20) for _ in range(rng.randrange(5, 60))], dtype=np.uint8) for _ in range(2))
        x, y = rng.randrange(len(a) - 2), rng.randrange(len(b) - 2)
        score = lambda k: int(se.AMINO_SCORES[a[x + k], b[y + k]])
        want = [sum(score(k) for k in range(3))]
        for side in (range(-1, -1 - min(x, y), -1), range(3, min(len(a) - x, len(b) - y))):
            total = best = reach = 0
            for n, k in enumerate(side, 1):
                total += score(k)
                if total > best:
                    best, reach = total, n
                if total < best - 7:
                    break
            want[0] += best
            want.append(reach)
        got = se.ungapped(np.concatenate((end, a, end)), np.concatenate((end, b, end)), np.array([x + 1]), np.array([y + 1]), 7)
        assert [int(got[0][0]), x + 1 - int(got[1][0]), int(got[2][0]) - (x + 4)] == want


def test_scores_of_many_extensions():
    """Extended together, pairs score what each scores alone; the other sequence's far end is never needed."""
    rng = random.Random(8)
    scores = se.AMINO_SCORES
    for _ in range(20):
        made = []
        for _ in range(30):
            a = [rng.randrange(22) for _ in range(rng.choice([0, 1, 7, 40]))]
            b = [c if rng.random() < 0.8 else rng.randrange(22) for c in a if rng.random() < 0.95] + [rng.randrange(22) for _ in range(rng.choice([0, 3, 900]))]
            made.append((np.array(a, dtype=np.uint8), np.array(b, dtype=np.uint8)))
        opening, extension, drop = rng.choice([(11, 1, 38), (5, 2, 20), (0, 3, 200)])
        got = dynamic.extend_scores([a for a, _ in made], [b for _, b in made], scores, opening, extension, drop)
        assert got.tolist() == [dynamic.extend(a, b, scores, opening, extension, drop)[0] for a, b in made]
        whole = [(a, b, len(a) // 2, len(b) // 2) for a, b in made if min(len(a), len(b)) > 8]
        assert dynamic.through_scores(whole, 3, scores, opening, extension, drop, cells=500) == [through(a, b, x, y, 3, scores, opening, extension, drop)[0] for a, b, x, y in whole]


def test_queries_meet_a_block_at_once():
    """All queries of a table have what each has alone, however few meetings are sorted at once; words of neighbours in a table do not pair."""
    rng = random.Random(12)
    queries, targets = planted(rng, se.RESIDUES[:20], 5, 8, 0.2)
    block = se.ProteinBlock([n for n, _ in targets], [t for _, t in targets])
    asked = (25, 40, 11, 1, 38, 16)
    alone = sorted(h for n, t in queries for h in block.hits(se.QueryTable([n], [t]), *asked))
    held, se.MEETINGS = se.MEETINGS, 50
    try:
        together = sorted(h for part in se._tables([n for n, _ in queries], [t for _, t in queries], 11, 40, 150) for h in block.hits(part, *asked))
    finally:
        se.MEETINGS = held
    assert alone == together == sorted(block.hits(se.QueryTable(*map(list, zip(*queries, strict=True))), *asked)) and alone
