import time

import numpy as np
import pytest

from seqloom.llm import suffixes


@pytest.mark.parametrize("names", [3, 1 << 19])
def test_runs_of_names(monkeypatch, names):
    """Names are induced by runs, whatever their length: equal to plain sorting, also where runs repeat."""
    monkeypatch.setattr(suffixes, "BUCKETS", 1)
    rng = np.random.default_rng(names)
    for k in range(300):
        text = rng.integers(1, 4, rng.integers(1, 40)) * (names // 3)
        text = np.tile(text, 4) if k % 3 == 0 else np.repeat(text, rng.integers(1, 9, len(text))) if k % 3 == 1 else text
        text = np.append(text, 0).astype(np.int32)
        assert suffixes.suffix_array(text, names + 1).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())  # noqa: B023


def test_names_in_time():
    """Half a million names of a large alphabet, with repeats: no step goes item by item."""
    rng = np.random.default_rng(5)
    text = rng.integers(1, 100_000, 250_000)
    text = np.concatenate((text, text[100_000:200_000], np.repeat(rng.integers(1, 100_000, 3000), 50), [0])).astype(np.int32)
    begun = time.time()
    order = suffixes.suffix_array(text, 100_000)
    assert time.time() - begun < 1.7
    assert (np.sort(order) == np.arange(len(text))).all() and (np.diff(text[order]) >= 0).all()
