import random
import time

import pytest

from seqloom.functions import codes
from seqloom.operators import families as fa


def plain_cover(a, b):
    if min(len(a), len(b)) < 15:
        return 0.0
    i, j, _ = codes.windows(a, b, 15, 12)
    return max(len(set(i.tolist())) / (len(a) - 14), len(set(j.tolist())) / (len(b) - 14))


def plain_score(s1, s2, flank):
    n = min(flank, len(s1), len(s2))
    ends = (s2[:n], s2[len(s2) - n :]) if n else ()
    return max((plain_cover(s1, e) for end in ends for e in (end, codes.opposite(codes.symbols(end)).tobytes().decode())), default=0.0)


@pytest.mark.parametrize("cells", [1 << 18, 3000, 50])
def test_scores(monkeypatch, cells):
    monkeypatch.setattr(fa, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(100):
        kind = rng.choice(["ACGT", "AACG", "AC", "ANé-"])
        a, b = ("".join(rng.choice(kind) for _ in range(rng.randrange(200))) for _ in range(2))
        b = a[rng.randrange(len(a) + 1) :] + b
        flank = rng.choice([200, 60, 15, 14])
        assert fa.flank_score(a, b, flank) == plain_score(a, b, flank)


def test_copies_are_compared_once(spark):
    """A thousand nodes of two texts: their flanks are compared for each two different texts, not for each pair of nodes."""
    rng = random.Random(3)
    a, b = ("".join(rng.choice("ACGT") for _ in range(100_000)) for _ in range(2))
    n = 1000
    seqs = spark.createDataFrame([(k, a if k % 3 else b) for k in range(3 * n)] + [(3 * n, None)], "name long, seq string").repartition(4)
    edges = [(3 * k + 1, 3 * k + d) for k in range(n) for d in (0, 2)] + [(0, 3 * n)]
    begun = time.time()
    got = {tuple(r) for r in fa.without_forks(spark.createDataFrame(edges, "src long, dst long"), seqs).collect()}
    assert time.time() - begun < 60
    assert got == {(s, d) for s, d in edges if d % 3 or not s}
