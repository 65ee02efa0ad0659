import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from seqloom.llm import simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found, word = [], ""
    for c in [*words, " "]:
        if c == " " or "\x09" <= c <= "\x0d":
            found += [word] if word else []
            word = ""
        else:
            word += c
    if not found:
        return 0
    grams = [" ".join(found[i : i + 4]) for i in range(len(found) - 3)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(ids, fps):
    f = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 4
    label = np.array([1 << 60 if i is None else i for i in ids])
    while True:
        new = np.where(near, label[None, :], 1 << 60).min(1)
        if (new == label).all():
            return [None if x == 1 << 60 else int(x) for x in label]
        label = new


def test_against_brute_force(both):
    got = sorted(map(tuple, simhash.query(both).collect()), key=str)
    rows = both.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    want = sorted(((r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, plain_classes([r.doc_id for r in rows], fps), strict=True)), key=str)
    assert got == want


def test_links_in_hot_blocks(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(900)} | {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    edges = simhash.links(nodes, bucket=40)
    f = np.array(fps, dtype=np.uint64)
    pairs = edges.collect()
    assert all(bin(fps[a] ^ fps[b]).count("1") <= 4 for a, b in pairs)
    from seqloom.operators.components import connected_components

    found = dict(map(tuple, connected_components(edges).collect()))
    assert [found.get(i, i) for i in range(len(f))] == plain_classes(range(len(f)), fps)


def test_one_of_each(both):
    kept = simhash.one_of_each(both)
    assert kept.columns == both.columns
    classes = simhash.near_duplicates(both).where("doc_id is not null")
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted({r.component_id for r in classes.collect()})
    assert [r.text for r in rows if r.doc_id is None] == ["a b c d e f"]


def test_empty(empty):
    assert simhash.query(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []


def test_extra_columns_stay(odd):
    assert simhash.one_of_each(odd.withColumn("component_id", F.lit(1))).columns[-1] == "component_id"
