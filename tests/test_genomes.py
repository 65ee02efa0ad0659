import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import annotations as an
from seqloom.operators import chromosomes as ch
from seqloom.operators import coordinates as co
from seqloom.operators import families as fa
from seqloom.operators import gaps as gp
from seqloom.plans import tables as tb
from seqloom.sources import files as fs


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_painted_axes(spark):
    items = spark.createDataFrame([(1, 7, 2, 4), (1, 8, 4, 6), (1, 9, 8, 30)], "key long, id long, beg long, end long")
    got = sorted((r.pos, r.id) for r in an.painted(items, ["key"], F.lit(10)).collect())
    assert got == [(2, 7), (3, 7), (4, 7), (5, 8), (6, 8)]
    with pytest.raises(Exception, match="overlap at 5"):
        an.painted(items.union(spark.createDataFrame([(1, 3, 5, 9)], items.schema)), ["key"], F.lit(10)).collect()


def test_projected_genes(spark):
    # Gene 1 lies in one piece, gene 2 in two pieces with gene 3 between them, gene 4 in an inverted piece.
    own = [1, 2, 3, 11, 12, 21, 22, 13, -32, -31, -30]
    aln = spark.createDataFrame([(1, 5, p, o) for p, o in enumerate(own, 1)], "chr long, acc long, pan long, own long")
    genes = spark.createDataFrame([(1, 1, 1, 3, "+"), (1, 2, 11, 13, "+"), (1, 3, 21, 22, "-"), (1, 4, 30, 32, "+")], "chr long, id long, beg long, end long, strand string")
    assert {(r.id, r.beg, r.end) for r in an.gene_blocks(genes, aln, 5, 8).collect()} == {(1, 1, 3), (3, 6, 7), (4, 9, 11)}
    # On the plus strand nothing parts gene 2, so its pieces are one run there.
    assert {(r.id, r.strand, r.beg, r.end) for r in an.stranded_blocks(genes, aln, 5, 8).collect()} == {(1, "+", 1, 3), (2, "+", 4, 8), (3, "-", 6, 7), (4, "-", 9, 11)}
    assert {(r.id, r.beg, r.end, r.strand) for r in co.to_pan(genes, aln, 5).collect()} == {(1, 1, 3, "+"), (2, 4, 8, "+"), (3, 6, 7, "-"), (4, 9, 11, "-")}


def plain_parts(members):
    """Parts of one group of (acc, beg, end), position by position."""
    lo, hi = min(b for _, b, _ in members), max(e for _, _, e in members)
    cov = {p: frozenset(a for a, b, e in members if b <= p <= e) for p in range(lo, hi + 1)}
    starts, last = [lo], None
    for p in range(lo, hi):
        if cov[p + 1] - cov[p]:
            if last == "down":
                starts.append(p)
            last = "up"
        if cov[p] - cov[p + 1]:
            last = "down"
    starts = sorted(set(starts))
    parts = []
    for b, following in zip(starts, [*starts[1:], None], strict=True):
        e = hi if following is None else following - 1
        while following is not None and e > b and not cov[e] - cov[e + 1] and cov[e] == cov[e - 1]:
            e -= 1
        parts.append((b, e))
    joined, carried = [], None
    for k, (b, e) in enumerate(parts):
        b, carried = (b if carried is None else carried), None
        if b == e and k < len(parts) - 1:
            carried = b
        else:
            joined.append((b, e))
    held = lambda b, e: len(frozenset().union(*[cov[p] for p in range(min(b, e), max(b, e) + 1)]))
    out = []
    for k, (b, e) in enumerate(joined):
        if k and 2 * held(joined[k - 1][1] + 1, b - 1) >= max(held(*joined[k - 1]), held(b, e)):
            out[-1] = (out[-1][0], e)
        else:
            out.append((b, e))
    return out


def test_split_groups(spark):
    """Groups with repeated genomes against the rule, position by position."""
    assert plain_parts([("a", 1, 50), ("a", 60, 100), ("b", 1, 48), ("b", 62, 100)]) == [(1, 51), (59, 100)]
    assert plain_parts([("a", 1, 50), ("a", 60, 100), ("b", 1, 100), ("c", 1, 100)]) == [(1, 100)]
    rng, groups = random.Random(2), {}
    for g in range(400):
        span = rng.choice([12, 60])
        groups[g] = [(rng.choice("abcde"), b := rng.randrange(1, span), b + rng.randrange(0, 25)) for _ in range(rng.randrange(1, 9))]
    rows = [(1, "+", g, *m) for g, own in groups.items() for m in own]
    rows += rows[:50]  # repeated rows
    items = spark.createDataFrame(rows, "chr long, strand string, group long, acc string, beg long, end long")
    got = {}
    for r in an.split_groups(items).collect():
        got.setdefault(r.group, []).append((r.part, r.beg, r.end))
    for g in groups:
        own = [m[3:] for m in rows if m[2] == g]
        accs = [m[0] for m in own]
        want = plain_parts(own) if len(set(accs)) < len(accs) else [(min(b for _, b, _ in own), max(e for _, _, e in own))]
        assert sorted(got[g]) == [(k, b, e) for k, (b, e) in enumerate(want, 1)], own
    assert an.split_groups(items.limit(0)).collect() == []


def test_chromosome_names(spark):
    g = spark.createDataFrame([("x_Chr3",), ("x_Chr12",), ("plastid",)], "chrom string")
    with pytest.raises(ValueError, match="name a chromosome"):
        an.chromosome_numbers(g)
    assert sorted(r.chr for r in an.chromosome_numbers(g, least=0.5).collect()) == [3, 12]


def plain_order(blocks, least):
    """Blocks that stay, all of them looked at again after each fall."""
    live = list(blocks)
    while True:
        query = sorted(x[1] for x in live)
        near = lambda x, y: abs(query.index(x[1]) - query.index(y[1])) == 1  # noqa: E731, B023
        loose = [x for k, x in enumerate(live[:-1]) if not near(x, live[k + 1]) or (k and not near(x, live[k - 1]))]
        loose = [x for x in loose if x[2] <= least]
        every = [x for k, x in enumerate(live[:-1]) if not near(x, live[k + 1]) or (k and not near(x, live[k - 1]))]
        if not loose or min(x[2] for x in every) > least:
            return [x[0] for x in live]
        live.remove(min(loose, key=lambda x: (x[2], live.index(x))))  # noqa: B023


def plain_skeleton(hits, least):
    """(number, block) of hits (number, q_beg, lo, hi, len, back)."""
    by_query = lambda rows: {h[0]: k for k, h in enumerate(sorted(rows, key=lambda h: (h[1], h[0])))}
    place = by_query(hits)
    rows = sorted(hits, key=lambda h: (h[2], -h[4], place[h[0]]))
    rows = [h for before, h in zip([None, *rows], rows, strict=False) if before is None or h[3] > before[3]]
    place = by_query(rows)
    far = lambda x, y: abs(place[x[0]] - place[y[0]]) > 1
    rows = [h for k, h in enumerate(rows) if not (0 < k < len(rows) - 1 and far(rows[k - 1], h) and far(h, rows[k + 1]))]
    place, blocks = by_query(rows), []
    for k, h in enumerate(rows):
        if k and not far(rows[k - 1], h):
            blocks[-1].append(h)
        else:
            blocks.append([h])
    kept = plain_order([(k, place[b[0][0]], max(h[3] for h in b) - min(h[2] for h in b)) for k, b in enumerate(blocks)], least)
    rows = [h for k in kept for h in blocks[k]]
    place, out = by_query(rows), []
    for k, h in enumerate(rows):
        new = not k or far(rows[k - 1], h) or h[5] != rows[k - 1][5]
        out.append((h[0], (out[-1][1] if out else 0) + int(new)))
    return out


def test_blocks_in_order():
    rng = random.Random(8)
    for _ in range(400):
        n = rng.randrange(0, 14)
        places = rng.sample(range(100), n)
        blocks = [(k, places[k], rng.randrange(1, 12)) for k in range(n)]
        least = rng.choice([3, 8, 100])
        assert gp.in_order(blocks, least) == plain_order(blocks, least)


def test_skeletons(spark):
    rng, rows, targets = random.Random(1), [], {}
    line = [(k, 100 * k, 1000 * k, 1000 * k + 400, 400, 0) for k in range(8)]
    targets["line"], targets["place"] = line, [*line, (90, 250, 4500, 4700, 200, 0)]
    targets["turn"], targets["inside"] = [h if h[0] < 4 else (*h[:5], 1) for h in line], [*line, (50, 10, 1100, 1200, 100, 0)]
    for t in range(150):
        targets[f"t{t}"] = [(k, rng.randrange(60), b := rng.randrange(200), b + rng.randrange(30), rng.randrange(1, 5), rng.randrange(2)) for k in range(rng.randrange(1, 16))]
    for t, own in targets.items():
        rows += [(t, n, q, *((lo, hi) if not back or lo == hi else (hi, lo)), size) for n, q, lo, hi, size, back in own]
    hits = spark.createDataFrame(rows, "s_id string, number long, q_beg long, s_beg long, s_end long, aln_len long")
    got = {}
    for r in gp.skeletons(hits, 40).collect():
        got.setdefault(r.s_id, []).append((r.number, r.block))
    for t, own in targets.items():
        own = [(*h[:5], int(h[5] and h[2] < h[3])) for h in own]
        assert sorted(got.get(t, [])) == sorted(plain_skeleton(own, 40)), own
    assert sorted(got["line"]) == [(k, 1) for k in range(8)] and sorted(got["place"]) == [(k, 1) for k in range(8)]
    assert [b for _, b in sorted(got["turn"])] == [1] * 4 + [2] * 4 and sorted(n for n, _ in got["inside"]) == list(range(8))


def test_free_segments_and_ends(spark):
    used = spark.createDataFrame([(1, 3, 5), (1, 5, 8), (1, 12, 20)], "key long, beg long, end long")
    got = lambda least: sorted((r.beg, r.end) for r in gp.free_segments(used, ["key"], F.lit(22), least).collect())
    assert got(1) == [(1, 2), (9, 11), (21, 22)] and got(3) == [(9, 11)]
    parts = gp.known_pieces(spark.createDataFrame([("s", 1, 4), ("s", 5, 8)], "q string, beg long, end long"), spark.createDataFrame([("s", "ACNNNNNG")], "q string, seq string"), "q")
    assert [(r.beg, r.seq) for r in parts.collect()] == [(1, "ACNN")]
    hits = spark.createDataFrame([(1, "q", "s", 1, 4, 2, 5, "AC-GT", "ACTG-"), (2, "q", "s", 5, 8, 9, 6, "TTAA", "TCGT")], "number long, q_id string, s_id string, q_beg long, q_end long, s_beg long, s_end long, q_aln string, s_aln string")
    q = spark.createDataFrame([("q", "ACGTTTAA")], "id string, seq string")
    s = spark.createDataFrame([("s", "GACTGTCGA")], "id string, seq string")
    assert {(r.number, r.side) for r in gp.wrong_ends(hits, q, s).collect()} == {(2, "base")}
    own = {r.base: r.own for r in gp.base_correspondence(hits).collect()}
    assert own == {2: 1, 3: 2, 5: 3, 9: -5, 8: -6, 7: -7, 6: -8}


def test_chromosomes(spark):
    g = spark.createDataFrame([(1, 1, "AACCGGTTAC"), (2, 1, "TTTTTCCCCC")], "acc long, chr long, seq string")
    spans = spark.createDataFrame([(1, 1, 1, 2, 6), (1, 1, 2, -7, -3), (1, 1, 3, 0, 4)], "chr long, acc long, id long, own_b long, own_e long")
    got = {r.id: (r.strand, r.beg, r.end, r.len, r.seq) for r in ch.own_sequences(spans, g).collect()}
    assert got == {1: ("+", 3, 5, 3, "CCG"), 2: ("-", -6, -4, 3, rc("CGG")), 3: ("", 0, 0, 0, "")}
    with pytest.raises(Exception, match="different signs"):
        ch.own_sequences(spans.withColumn("own_b", -F.col("own_b")), g).collect()
    p = spark.createDataFrame([(1, 7, 1, 1, 4, 1), (1, 7, 1, 5, 10, -2), (2, 7, 1, 1, 10, -1), (2, 8, 1, 1, 2, 2)], "acc long, i_ref long, i_acc long, beg long, end long, pos long")
    assert {(r.acc, r.chr, r.seq) for r in ch.rebuilt(p, g).collect()} == {(1, 7, "AACC" + rc("GGTTAC")), (2, 7, rc("TTTTTCCCCC"))}


def test_flanks_and_directions(spark):
    rng = random.Random(1)
    text = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    a = text(300)
    assert fa.flank_score(a, text(60) + a[:40] + rc(a[:200])) == 1.0 and fa.flank_score(a, text(300)) < 0.3
    assert fa.flank_score("", a) == 0.0 and fa.flank_score("ACG", "ACG") == 0.0
    # Node 1 leads to 2, which holds its end, and to 3, which does not.
    seqs = spark.createDataFrame([(1, a), (2, text(50) + a), (3, text(400))], "name long, seq string")
    edges = spark.createDataFrame([(1, 2), (1, 3)], "src long, dst long")
    assert {tuple(r) for r in fa.without_forks(edges, seqs).collect()} == {(1, 2)}
    assert {tuple(r) for r in fa.without_umbrellas(spark.createDataFrame([(1, 3), (2, 3)], "src long, dst long"), seqs).collect()} == set()
    frame = "ATG" + "GCT" * 40
    names = spark.createDataFrame([(1, frame), (2, rc(frame)[:90]), (3, frame[:60]), (4, "AC")], "name long, seq string")
    nested = spark.createDataFrame([(2, 1, "-", 0.9), (3, 2, "-", 0.5), (3, 2, "+", 0.4)], "src long, dst long, strand string, coverage double")
    one = fa.oriented(names.select(F.lit(1).alias("family"), "name"), names, nested)
    got = {r["name"]: (r.strand, r.seq) for r in one.collect()}
    first = got[1][0]
    other = {"+": "-", "-": "+"}
    assert {k: v[0] for k, v in got.items()} == {1: first, 2: other[first], 3: first}
    assert got[2][1] == (rc(rc(frame)[:90]) if got[2][0] == "-" else rc(frame)[:90])


def test_stores_and_guards(spark, tmp_path):
    aln = spark.createDataFrame([(1, a, p, p * (-1) ** a) for a in (3, 4) for p in range(1, 9)], "chr long, acc long, pan long, own long")
    fs.write_map(aln, str(tmp_path / "m"))
    assert sorted(map(tuple, fs.read_map(spark, str(tmp_path / "m")).collect())) == sorted(map(tuple, aln.collect()))
    one = fs.read_map(spark, str(tmp_path / "m"), 4)
    assert one.count() == 8 and "PartitionFilters: [isnotnull(acc" in one._jdf.queryExecution().toString()
    assert fs.map_genomes(spark, str(tmp_path / "m")) == [3, 4]
    assert fs.is_done(spark, str(tmp_path / "m")) and not fs.is_done(spark, str(tmp_path / "none"))
    (tmp_path / "a.x.log").write_text("begin\nall DONE here\n")
    (tmp_path / "b.log").write_text("begin\n")
    assert fs.is_done(spark, str(tmp_path / "a.x.log")) and not fs.is_done(spark, str(tmp_path / "b.log"))
    assert fs.prefixes(spark, str(tmp_path)) == ["a", "b"]
    assert fs.check_file(spark, str(tmp_path / "b.log")) and fs.check_dir(spark, str(tmp_path))
    for check, bad in ((fs.check_file, "m"), (fs.check_dir, "b.log"), (fs.check_file, "none")):
        with pytest.raises(OSError, match=bad):
            check(spark, str(tmp_path / bad))
    with pytest.raises(ValueError, match="as many"):
        tb.combinations(spark, 2, 3)
    assert tb.first_rows(aln, 5).count() == 5
