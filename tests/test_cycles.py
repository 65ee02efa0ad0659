import random

from seqloom.operators import graphs as gr


def strong(pairs):
    """Each node's class by plain reachability, named by its smallest member."""
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set())
    reach = {}
    for v in near:
        seen, todo = set(), [v]
        while todo:
            for w in near[todo.pop()]:
                if w not in seen:
                    seen.add(w)
                    todo.append(w)
        reach[v] = seen
    return {(v, min([v, *[w for w in reach[v] if v in reach[w]]])) for v in near}


def test_cycles_against_reachability(spark):
    rng = random.Random(5)
    # Eight graphs beside each other.
    pairs = [(100 * k + rng.randrange(12), 100 * k + rng.randrange(12)) for k in range(8) for _ in range(10 + 2 * k)]
    pairs = [p for p in pairs if p[0] != p[1]]
    got = gr.strong_components_by_cycles(spark.createDataFrame(pairs, "src long, dst long"), 12)
    assert {tuple(r) for r in got.collect()} == strong(pairs)
    assert gr.strong_components_by_cycles(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_long_paths_take_few_rounds(spark, monkeypatch):
    """A path of 300 nodes into a cycle of 3, each node linked to the next two: steps grow with the logarithm of the path."""
    step = {k: k + 1 for k in range(302)} | {302: 300}
    pairs = {(k, step[k]) for k in step} | {(k, step[step[k]]) for k in step}
    cuts, cut = [], gr.cut
    monkeypatch.setattr(gr, "cut", lambda df: cuts.append(1) or cut(df))
    got = gr.strong_components(spark.createDataFrame(sorted(pairs), "src long, dst long"), 10)
    assert {tuple(r) for r in got.collect()} == strong(pairs)
    assert len(cuts) < 80
