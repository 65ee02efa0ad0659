import random
from collections import Counter

from seqloom.operators import graphs


def plain(edges):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    label, states = {n: n for n in near}, []
    while label not in states:
        states.append(label)
        votes = {n: Counter([label[n], *(label[m] for m in near[n])]) for n in near}
        label = {n: min(v, key=lambda c: (-v[c], c)) for n, v in votes.items()}
    cycle = states[states.index(label) :]
    return {n: min(s[n] for s in cycle) for n in near}, len(states)


def test_until_labels_repeat(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 115)]  # a label moves one node a round
    edges = chain + [(rng.randrange(40), rng.randrange(40)) for _ in range(60)]
    want, rounds = plain(edges)
    assert rounds > 11
    got = {r.node: r.community for r in graphs.communities(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == want
