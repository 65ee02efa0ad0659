import numpy as np
import pytest

from seqloom.operators import search as se


@pytest.mark.parametrize("symbols", [1, 2, 4, 5])
def test_markers_are_the_first_least_words(symbols):
    """One window after another gives the same places, with ties, other symbols and words of any length."""
    rng = np.random.default_rng(symbols)
    for _ in range(60):
        seq, word = rng.integers(0, symbols, rng.integers(0, 120)).astype(np.uint8), int(rng.integers(2, 17))
        size = word + int(rng.integers(0, 16))
        at, found = se.markers(seq, size, word)
        packed = [sum(int(c & 3) << 2 * (word - 1 - k) for k, c in enumerate(seq[i : i + word])) for i in range(len(seq) - word + 1)]
        assert [packed[i] for i in at] == [int(w) for w in found]

        def hashed(i):
            h = (packed[i] + 1) * int(se._MIX) % (1 << 64)
            return 1 << 63 if (seq[i : i + word] > 3).any() else ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 % (1 << 64)) >> 1

        least = {min(range(i, i + size - word + 1), key=lambda j: (hashed(j), j)) for i in range(len(seq) - size + 1)}
        assert at.tolist() == sorted(j for j in least if hashed(j) < 1 << 63)


def test_words_that_no_query_has_stay_where_they_are(spark, monkeypatch):
    """Few words of the targets leave their task, all that a query has among them, and the hits are those of all words."""
    rng = np.random.default_rng(5)
    text = lambda n: "".join(rng.choice(list("ACGT"), n))
    asked = [text(80) for _ in range(3)]
    rows = [(f"t{k}", text(900) + asked[k % 3] + text(900)) for k in range(12)] + [("none", None), ("short", "ACGT"), ("other", "N" * 300)]
    q, s = spark.createDataFrame(list(enumerate(asked)), "name long, seq string"), spark.createDataFrame(rows, "name string, seq string")
    words = se._marked(q.selectExpr("CAST(name AS STRING) AS q", "seq"), 28, "q string")
    t = s.withColumnRenamed("name", "s")
    every, some = se._marked(t, 28, "s string"), se._marked(t, 28, "s string", se._mask(words))
    wanted = {r.word for r in words.collect()}
    assert {(r.s, r.at) for r in every.collect() if r.word in wanted} <= {(r.s, r.at) for r in some.collect()}
    assert some.count() < 0.2 * every.count()
    found = sorted(map(str, se.local_hits(q, s).collect()))
    monkeypatch.setattr(se, "_mask", lambda words: np.ones(se.SLOTS, dtype=bool))
    assert sorted(map(str, se.local_hits(q, s).collect())) == found and len(found) >= 12
