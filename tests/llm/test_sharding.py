import zlib
from collections import Counter

from seqloom.llm import sharding


def one(key, n):
    z = (key + 0x9E3779B97F4A7C15) % 2**64
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    z = (z ^ z >> 27) * 0x94D049BB133111EB % 2**64
    key, b, j = z ^ z >> 31, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_rows(both):
    got = sharding.query(both).collect()
    want = Counter((r.doc_id, len(t := (r.text or "").encode()) + 1, zlib.crc32(t), one(r.doc_id or 0, 8), one(r.doc_id or 0, 9)) for r in both.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    for s in range(8):
        own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        ids = [-1 if r.doc_id is None else r.doc_id for r in own]
        assert ids == sorted(ids)
    assert all(r.grown_shard in (r.shard, 8) and r.law == "key" for r in got)


def test_spread():
    import numpy as np

    found = sharding.jump(sharding.mix(np.arange(80_000)), 8)
    assert all(abs(n - 10_000) < 500 for n in Counter(found.tolist()).values())


def test_empty(empty):
    assert sharding.query(empty).collect() == []
