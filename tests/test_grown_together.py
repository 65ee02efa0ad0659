import random

import numpy as np
import pytest

from seqloom.functions import dynamic as dy
from seqloom.operators import search as sr


def changed(rng, seq, kinds):
    out = []
    for c in seq:
        chance = rng.random()
        if chance < 0.04:
            continue
        out += [rng.randrange(kinds)] * (chance < 0.08) + [rng.randrange(kinds) if chance > 0.95 else c]
    return out


@pytest.mark.parametrize("rows", [1, 10, 256])
@pytest.mark.parametrize("opening, extension, drop", [(10, 2, 30), (1, 1, 30), (11, 1, 38), (10, 2, 5)])
def test_extensions_together(rows, opening, extension, drop):
    """Score, places and path are those of one extension after another, also where some go on beyond the first rows."""
    rng = random.Random(rows + drop)
    for kinds, scores in ((2, sr.base_scores(1, -2)), (5, sr.base_scores(1, -2)), (22, sr.AMINO_SCORES)):
        a = [[rng.randrange(kinds) for _ in range(rng.choice([0, 1, 9, 60, 400]))] for _ in range(20)]
        b = [changed(rng, p, kinds) if k % 4 else [rng.randrange(kinds) for _ in range(30)] for k, p in enumerate(a)]
        a, b = ([np.array(p, dtype=np.uint8) for p in c] for c in (a, b))
        assert dy.extend_all(a, b, scores, opening, extension, drop, rows) == [dy.extend(p, q, scores, opening, extension, drop) for p, q in zip(a, b, strict=True)]


def test_seeds_of_a_repeat_grow_together(monkeypatch):
    """A sequence of short repeats has an alignment on each diagonal: few of them are extended alone."""
    alone, extend = [], dy.extend
    monkeypatch.setattr(dy, "extend", lambda *a: alone.append(1) or extend(*a))
    rng = random.Random(2)
    q, s = ("".join("ACGTC"[k % 5] if rng.random() > 0.01 else "G" for k in range(700)) for _ in range(2))
    seeds = [(x, y) for x in range(0, 670, 3) for y in range(x % 5, 670, 5) if q[x : x + 28] == s[y : y + 28]]
    hits = sr.grown(q, s, seeds, 28, sr.base_scores(1, -2), 10, 2, 30)
    assert len(hits) > 100 and len(alone) < len(hits) / 2
    assert all(path.count("M") >= 28 and score >= 28 for score, _, _, path in hits)
