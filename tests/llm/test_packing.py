import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from seqloom.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


def whole(docs):
    plain = Tokenizer.from_file(FILE)
    return [(r.doc_id, [*plain.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect()]


def check(got, docs, lanes):
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append(r)
    assert sorted(by) == list(range(len(by)))
    short = 0
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        total = sum(r.length for r in own)
        assert 0 < total <= 2048
        short += total < 2048
    assert short <= lanes
    want, have = Counter(), Counter()
    unique = Counter(d for d, _ in docs)
    for d, ids in docs:
        want[d] += len(ids)
    for r in got:
        have[r.doc_id] += r.length
    assert have == want
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for d, ids in docs:
        if unique[d] == 1:
            own = sorted(pieces[d], key=lambda r: r.start)
            assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
            for r in own:
                assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_every_id_in_one_piece(both):
    check(packing.pack(both, FILE, lanes=7).collect(), whole(both), 7)


def test_proportions_hold_in_each_window(small):
    docs = whole(small)
    source = {r.doc_id: r.source for r in small.collect()}
    share = Counter()
    for d, ids in docs:
        share[source[d]] += len(ids)
    total = sum(share.values())
    seen = Counter()
    got = packing.pack(small, FILE, lanes=2).collect()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        seen[source[r.doc_id]] += r.length
        done = sum(seen.values())
        # A lane may run out of a source by what its draw of documents lacks.
        assert all(abs(seen[s] - done * share[s] / total) < 0.06 * total for s in share)
    assert len({r.sequence_id for r in got}) <= total // 2048 + 2


def test_weights(small):
    got = packing.pack(small, FILE, lanes=1, weights={"src0": 3.0, "src1": 1.0}).collect()
    source = {r.doc_id: r.source for r in small.collect()}
    early = Counter()
    for r in got:
        if r.sequence_id < 3:
            early[source[r.doc_id]] += r.length
    assert abs(early["src0"] / early["src1"] - 3) < 0.6


def test_default_lanes_and_empty(small, empty):
    check(packing.query(small, FILE).collect(), whole(small), 4 * small.rdd.getNumPartitions())
    assert packing.query(empty, FILE).collect() == []
