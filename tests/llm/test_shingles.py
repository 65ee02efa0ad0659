import random

import numpy as np
import pytest

import corpus_pipeline
from seqloom.llm import shingles


def plain_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or {" ".join(words)}


def plain_firsts(texts):
    """Positions of the first text of each class of links."""
    sets = [plain_set(t) for t in texts]
    label = list(range(len(sets)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                label[b] = a
    return {i for i in range(len(sets)) if top(i) == i}


def near_copies():
    """Texts of 200 words and copies of each with one to eight other words: similarity 0.67 to 0.98."""
    rng = random.Random(7)
    out = []
    for _ in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        out.append(" ".join(base))
        for n in range(1, 9):
            other = list(base)
            for at in rng.sample(range(200), n):
                other[at] = f"v{rng.randrange(5000)}"
            out.append(" ".join(other))
    return out + ["Short text", "short  TEXT", "other text", "a b c d e f"]


@pytest.mark.parametrize("members", [2048, 3])
def test_near_copies_of_similarity_0_8(spark, members):
    texts = near_copies()
    rows = spark.createDataFrame(list(enumerate(texts)), "uid long, text string").repartition(4)
    assert {r.uid for r in shingles.firsts(rows, members=members).collect()} == plain_firsts(texts)


def test_stage_on_near_copies(spark):
    texts = near_copies()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == plain_firsts(texts)


def test_forest_of_one_group():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[k:], rng.integers(0, 1 << 62, k, dtype=np.uint64)))) for k in (0, 5, 10, 60)]
    assert shingles.forest(sets) == ([0, 0], [1, 2])


def test_fingerprints_and_bands_propose(spark):
    """Near fingerprints, equal ones and a band in common each hang two nodes together; nodes with none of them stay apart."""
    rows = [(1, 0, [1]), (2, 0b11, [2]), (3, -1, [1]), (4, 0x0F0F0F0F, [4]), (5, 0x0F0F0F0F, [5]), (6, 0x5555555555555555, [6])]
    nodes = spark.createDataFrame(rows, "node long, fp long, keys array<long>")
    assert {tuple(sorted(r)) for r in shingles.candidates(nodes).collect()} == {(1, 2), (1, 3), (4, 5)}


def test_fingerprint_of_a_set(spark):
    text = "one two three four five six seven one two three four five six"
    signed = spark.createDataFrame([(1, text), (2, "")], "uid long, text string").mapInArrow(shingles._signed, "uid long, same long, size long, fp long, keys array<long>")
    for row, words in zip(signed.orderBy("uid").collect(), (text, ""), strict=True):
        held = shingles.shingles(words.encode()).tolist()
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in held) > len(held))
        assert row.fp % (1 << 64) == want
