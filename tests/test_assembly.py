import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import assembly as am
from seqloom.operators import graphs as gr


def plain(base, breaks, loci, doubles):
    """The new axis as whole rows of columns, genome by genome."""
    out = set()
    for chrom in {b[0] for b in base} | {x[0] for x in loci}:
        own = sorted(b[1:] for b in breaks if b[0] == chrom)
        top = max((b[2] for b in base if b[0] == chrom), default=0)
        new, place, start = 1, {}, {}
        inside = {p: k for k, (_, beg, end, _) in enumerate(own) for p in range(beg + 1, end)}
        old = 1
        while old <= top:
            if old in inside:
                k = inside[old]
                _, beg, end, width = own[k]
                wide = width if width >= end - beg - 1 and width else end - beg - 1
                start[own[k][0]] = new if wide == width else None
                new += wide
                old = end
            else:
                place[old], new, old = new, new + 1, old + 1
                meets = [b for b in own if b[1] == old - 1 and b[2] == old and b[3]]
                for b in meets:  # nothing was between the two
                    start[b[0]] = new
                    new += b[3]
        for acc in {b[1] for b in base if b[0] == chrom} | {x[2] for x in loci if x[0] == chrom}:
            row = [(place[p], v, 0) for c, a, p, v in base if (c, a) == (chrom, acc) and v and p in place]
            width = {b[0]: b[3] for b in own}
            row += [(start[i] + col - 1, v, 1) for c, i, a, col, v in loci if (c, a) == (chrom, acc) and v and start.get(i) and 1 <= col <= width[i]]
            seen = {}
            for pan, v, locus in sorted(row, key=lambda x: (x[2], x[0], x[1])):
                if abs(v) in seen:
                    if doubles == "raise":
                        raise ValueError(v)
                    if locus:
                        continue
                seen[abs(v)] = pan
                out.add((chrom, acc, pan, v))
    return out


def made(rng, clash):
    base, breaks, loci = [], [], []
    for chrom in (1, 2):
        at = 0
        for k in range(rng.randrange(0, 5)):
            beg = at + rng.randrange(1, 6)
            end = beg + rng.randrange(1, 6)
            breaks.append((chrom, k, beg, end, rng.randrange(0, 9)))
            at = end
        top = at + rng.randrange(1, 8)
        for acc in range(3):
            values = rng.sample(range(1, 300), 200)
            base += [(chrom, acc, p, rng.choice([1, -1]) * values.pop()) for p in range(1, top + 1) if rng.random() < 0.8]
            for _, k, _, _, width in [b for b in breaks if b[0] == chrom]:
                loci += [(chrom, k, acc, c, (rng.choice([b[3] for b in base]) if clash and rng.random() < 0.2 else values.pop())) for c in range(1, width + 2) if rng.random() < 0.7]
    return base, breaks, loci


def tables(spark, base, breaks, loci):
    return (
        spark.createDataFrame(base, "chr long, acc long, pan long, own long"), spark.createDataFrame(breaks, "chr long, id long, beg long, end long, width long"),
        spark.createDataFrame(loci, "chr long, id long, acc long, col long, own long"),
    )


@pytest.mark.parametrize("seed", range(6))
def test_assembled(spark, seed):
    base, breaks, loci = made(random.Random(seed), seed % 2)
    got = {tuple(r) for r in am.assembled(*tables(spark, base, breaks, loci), doubles="zero", bins=4).collect()}
    assert got == plain(base, breaks, loci, "zero")


def test_doubles_raise(spark):
    base, breaks, loci = [(1, 0, 1, 5), (1, 0, 5, 9)], [(1, 0, 1, 5, 4)], [(1, 0, 0, 1, -9)]
    with pytest.raises(Exception, match="position 9 of genome 0 comes twice"):
        am.assembled(*tables(spark, base, breaks, loci)).collect()
    assert {tuple(r) for r in am.assembled(*tables(spark, base, breaks, [(1, 0, 0, 1, 7)])).collect()} == {(1, 0, 1, 5), (1, 0, 2, 7), (1, 0, 6, 9)}
    with pytest.raises(ValueError, match="raise or zero"):
        am.assembled(*tables(spark, base, breaks, loci), doubles="x")


def test_lines_and_insertions(spark):
    loci = spark.createDataFrame([(1, "a", "AC"), (1, "b", "A-"), (3, "a", ""), (4, "c", "ACG")], "locus long, genome string, seq string")
    genomes = spark.createDataFrame([("a",), ("b",), ("a",)], "genome string")
    got = {(r.genome, r.locus): r.seq for r in am.genome_lines(loci, genomes).collect()}
    assert got == {("a", 1): "AC", ("b", 1): "A-", ("a", 2): "", ("b", 2): "", ("a", 3): "", ("b", 3): "", ("a", 4): "---", ("b", 4): "---"}
    assert am.genome_lines(loci.limit(0), genomes).collect() == []
    clean = spark.createDataFrame([(1, 0, 5, 50), (1, 1, 5, 70), (1, 1, 6, 71)], "chr long, acc long, pan long, own long")
    final = spark.createDataFrame([(1, 0, 9, 50)], "chr long, acc long, pan long, own long")
    assert {tuple(r) for r in am.inserted_back(clean, final, 0).collect()} == {(1, 0, 9, 50), (1, 1, 9, 70)}
    with pytest.raises(Exception, match="column 9 of genome 1 is taken"):
        am.inserted_back(clean, final.union(spark.createDataFrame([(1, 1, 9, 3)], final.schema)), 0).collect()


def test_filtered_edges(spark):
    rng = random.Random(3)
    edges = {(rng.randrange(30), rng.randrange(30)) for _ in range(45)}
    edges = sorted((a, b) for a, b in edges if a != b)
    df = spark.createDataFrame(edges, "src long, dst long")
    near = lambda es: {(min(e), max(e)) for e in es}

    def parts(es):
        label = {v: v for e in es for v in e}
        for _ in label:
            for a, b in es:
                label[a] = label[b] = min(label[a], label[b])
        return len(set(label.values())), label

    nodes = {v: v for e in edges for v in e}
    cuts = {e for e in near(edges) if parts([*(near(edges) - {e}), *((v, v) for v in nodes)])[0] > parts([*near(edges), *((v, v) for v in nodes)])[0]}
    held = {v for e in near(edges) - cuts for v in e}
    assert {tuple(r) for r in gr.filtered_edges(df, cycles=True).collect()} == {e for e in edges if e[0] in held and e[1] in held}
    groups = spark.createDataFrame([(v, v % 3) for v in nodes if v != 4], "node long, community long")
    assert {tuple(r) for r in gr.filtered_edges(df, groups=groups).collect()} == {(a, b) for a, b in edges if a % 3 == b % 3 and 4 not in (a, b)}
    paired = {v for a, b in edges if (b, a) in edges for v in (a, b)}
    assert {tuple(r) for r in gr.filtered_edges(df, paired=True).collect()} == {e for e in edges if e[0] in paired}
    assert gr.filtered_edges(df.where(F.lit(False)), least=2, cycles=True, paired=True).collect() == []
