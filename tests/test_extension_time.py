import random
import time

import numpy as np

from seqloom.functions import dynamic as dy
from seqloom.operators import search as sr


def test_many_seeds_of_one_line():
    """Seeds of one diagonal are one run: a long match with a seed at each place costs one look at its diagonal."""
    rng = random.Random(4)
    a = "".join(rng.choice("ACGT") for _ in range(20_000))
    begun = time.time()
    got = sr.grown(a, "GG" + a, [(k, k + 2) for k in range(0, 19_900)], 28, sr.base_scores(1, -2), 10, 2, 30)
    assert [(g[0], g[1], g[2], len(g[3])) for g in got] == [(20_000, 0, 2, 20_000)]
    assert time.time() - begun < 1


def test_gaps_at_the_ends():
    """A path goes back through gaps on both sides, and without a match nothing is taken."""
    scores = sr.base_scores(1, -2)
    a, b = np.array([0, 1, 2, 3] * 8, dtype=np.uint8), np.array([0, 1, 2, 3] * 4 + [0, 1] + [0, 1, 2, 3] * 4, dtype=np.uint8)
    assert dy.extend(a, b, scores, 1, 1, 30) == (29, 32, 34, "M" * 16 + "BB" + "M" * 16)
    assert dy.extend(b, a, scores, 1, 1, 30)[:3] == (29, 34, 32)
    assert dy.extend(a, b[1:3], scores, 10, 2, 5)[0] == 0 and dy.extend(a[:0], b, scores, 10, 2, 5) == (0, 0, 0, "")
