import random
import struct
from collections import Counter, defaultdict

import pytest
import xxhash

from seqloom.operators import graphs
from seqloom.operators import modularity as mo


def weights(edges):
    w = Counter()
    for a, b in edges:
        if a != b and None not in (a, b):
            w[a, b] += 1
            w[b, a] += 1
    return w


def score(w, label):
    volume, total, inner = Counter(), sum(w.values()), sum(n for (a, b), n in w.items() if label[a] == label[b])
    for (a, _), n in w.items():
        volume[label[a]] += n
    return total * inner - sum(v * v for v in volume.values())


def halved(node, turn):
    h = 42
    for x in (node, turn // 2):
        h = xxhash.xxh64(struct.pack("<q", x), seed=h).intdigest()
    return h % 2 == turn % 2


def plain(edges, least=1e-3):
    """The rule over dictionaries, on the graph itself at every level: a node of a level is a set of nodes that move together."""
    w = weights(edges)
    total, groups = sum(w.values()), {n: n for n, _ in w}
    while total:
        k, between = Counter(), Counter()
        for (a, b), n in w.items():
            k[groups[a]] += n
            if groups[a] != groups[b]:
                between[groups[a], groups[b]] += n
        label, turn = {g: g for g in k}, 0
        value = lambda label, groups=groups: score(w, {n: label[g] for n, g in groups.items()})
        first = value(label)
        while True:
            before = value(label)
            for _ in range(2):
                volume, size, to = Counter(), Counter(label.values()), defaultdict(Counter)
                for g, c in label.items():
                    volume[c] += k[g]
                for (a, b), n in between.items():
                    to[a][label[b]] += n
                new = dict(label)
                for g in label:
                    if halved(g, turn):
                        own, stay = label[g], total * to[g][label[g]] - k[g] * (volume[label[g]] - k[g])
                        free = [c for c, n in to[g].items() if n and c != own and (size[own] > 1 or size[c] > 1 or c < own)]
                        best = max(((total * to[g][c] - k[g] * volume[c], -c) for c in free), default=(stay, 0))
                        if best[0] > stay:
                            new[g] = -best[1]
                if value(new) > value(label):
                    label = new
                turn += 1
            if value(label) == before or value(label) - before < least * total * total:
                break
        if value(label) == first:
            break
        gain, groups = value(label) - first, {n: label[g] for n, g in groups.items()}
        if gain < least * total * total:
            break
    named = defaultdict(list)
    for n, g in groups.items():
        named[g].append(n)
    return {n: min(named[g]) for n, g in groups.items()}


def planted(rng, groups, size, links, across):
    return [(rng.randrange(size) + g * size, rng.randrange(size) + g * size) for g in range(groups) for _ in range(links)] + [
        (rng.randrange(groups * size), rng.randrange(groups * size)) for _ in range(across)
    ]


def found(spark, edges):
    return {r.node: r.community for r in mo.modular_communities(spark.createDataFrame(edges, "src long, dst long")).collect()}


def test_planted_groups(spark):
    rng = random.Random(5)
    edges = planted(rng, 6, 12, 50, 20)
    got, w = found(spark, edges), weights(edges)
    assert got == plain(edges)
    df = spark.createDataFrame(edges, "src long, dst long")
    spread = graphs.communities(df)
    assert score(w, got) >= score(w, {r.node: r.community for r in spread.collect()})
    assert score(w, got) >= score(w, {n: n // 12 for n in got})
    q = mo.modularity(df, spark.createDataFrame(list(got.items()), "node long, community long")).first()[0]
    assert q == pytest.approx(score(w, got) / sum(w.values()) ** 2)


def partitions(nodes):
    if not nodes:
        yield []
        return
    for rest in partitions(nodes[1:]):
        for i in range(len(rest)):
            yield [*rest[:i], [nodes[0], *rest[i]], *rest[i + 1 :]]
        yield [[nodes[0]], *rest]


def test_the_rule_is_near_the_best_of_all_partitions():
    rng = random.Random(11)
    for _ in range(12):
        edges = planted(rng, 2, 4, 8, 3)
        w = weights(edges)
        best = max(score(w, {n: i for i, p in enumerate(ps) for n in p}) for ps in partitions(sorted({n for n, _ in w})))
        assert score(w, plain(edges)) >= 0.8 * best


def test_loops_nulls_stars_and_nothing(spark):
    edges = [(1, 1), (None, 2), (3, None), (5, 6), (6, 5), *[(100, i) for i in range(101, 140)], (7, 8), (7, 8)]
    got = found(spark, edges)
    assert got == plain(edges)
    assert got[5] == got[6] == 5 and got[7] == got[8] == 7 and {got[i] for i in range(100, 140)} == {100}
    assert mo.modular_communities(spark.createDataFrame([(1, 1)], "src long, dst long")).collect() == []
