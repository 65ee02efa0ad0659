import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import spans, suffixes


def plain(rows, width=100):
    """Of (doc_id, text) rows, in order."""
    seen, out = set(), []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    for doc, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=np.int8)
        for i in range(len(data) - width + 1):
            w = data[i : i + width]
            if w in seen:
                gone[i : i + width] = 1
            seen.add(w)
        edges = np.diff(gone, prepend=0)
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((doc, len(data), int(gone[: len(data)].sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("buckets", [0, 512])
def test_suffix_arrays(monkeypatch, buckets):
    monkeypatch.setattr(suffixes, "BUCKETS", buckets)
    rng = random.Random(1)
    for _ in range(200):
        k = rng.choice([1, 2, 3, 200])
        t = [rng.randrange(1, k + 1) for _ in range(rng.randrange(60))] + [0]
        got = suffixes.suffix_array(np.array(t, dtype=np.int16), k + 1)
        assert got.tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_common_prefixes():
    rng = random.Random(5)
    for _ in range(100):
        pieces = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(40))) for _ in range(4)]
        joined = b"\0".join(pieces) + b"\0"
        room = np.array([*(len(p) - i for p in pieces for i in range(len(p) + 1)), 0], dtype=np.int32)
        order = sorted(range(len(joined) + 1), key=lambda i: joined[i:])
        got = suffixes.common(np.frombuffer(joined + b"\0" * 30, np.uint8), np.array(order), room, 20)
        for a, b in zip(order, order[1:], strict=False):
            n = 0
            while n < min(20, room[a], room[b]) and joined[a + n] == joined[b + n]:
                n += 1
            assert got[b] == n


def test_a_full_shard_by_recursion():
    """2 MiB of text: three levels and more, and neighbours in order."""
    import pyarrow.parquet as pq

    texts = [(t or "").encode() for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    joined = (b"\0".join(texts) * 2)[: spans.SHARD]
    text = np.append(np.frombuffer(joined, np.uint8).astype(np.int16) + 1, np.int16(0))
    levels = []
    order = suffixes.suffix_array(text, 258, levels)
    assert len(levels) >= 3 and levels[1][1] > 2048 and levels[1][0] > 500_000
    assert np.array_equal(np.sort(order), np.arange(len(text)))
    rank = np.empty(len(text), dtype=np.int64)
    rank[order] = np.arange(len(text))
    # Each suffix is above its neighbour by its first symbol, or by the order of the two that follow.
    a, b = order[:-1], order[1:]
    follow = np.append(rank, -1)
    assert ((text[a] < text[b]) | ((text[a] == text[b]) & (follow[a + 1] < follow[b + 1]))).all()


def test_repeated():
    rng = random.Random(2)
    for _ in range(60):
        pieces = [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(60))) for _ in range(5)]
        pieces += [pieces[0] + b"xyz", b"q" + pieces[-1]]
        seen, want = set(), []
        for p in pieces:
            for i in range(len(p) + 1):
                w = p[i : i + 8]
                want.append(len(w) == 8 and w in seen)
                seen.add(w)
        assert suffixes.repeated(pieces, 8).tolist() == want


def test_odd_rows(both):
    got = Counter(tuple(r) for r in spans.query(both).collect())
    assert got == plain([(r.doc_id, r.text) for r in both.collect()])


@pytest.mark.parametrize("hot, crowd", [(512, 1 << 14), (3, 1 << 14), (3, 5)])
def test_hot_lines(spark, monkeypatch, hot, crowd):
    monkeypatch.setattr(spans, "HOT", hot)
    monkeypatch.setattr(spans, "CROWD", crowd)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    line, short, long = text(40), text(14), "ab" * 3000
    rows = [(i, f"{text(30)} {line} {text(30)}") for i in range(60)] + [(100 + i, f"{text(12)}{short}{text(12)}") for i in range(60)]
    rows += [(200, long), (201, long[1:]), (202, "a" * 500), (203, "a" * 700 + "b"), (204, rows[0][1]), (205, rows[1][1][40:]), (206, ""), (207, None)]
    rows += [(300 + i, rows[3][1][:k] + word() + rows[3][1][k:]) for i, k in enumerate(range(0, 400, 13))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(tuple(r) for r in spans.spans(docs, buckets=7).collect()) == plain(rows)


def test_groups_stay_small_under_a_short_common_line(spark, monkeypatch):
    """Many documents share a line of 95 bytes, and a few longer passages around it: what meets by one key does not grow with them."""
    monkeypatch.setattr(spans, "CROWD", 300)
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, largest = text(95), []
    for n in (600, 2400):
        rows = [(i, text(120) + line + text(120)) for i in range(n)]
        rows += [(n + i, rows[i][1][60:]) for i in range(20)] + [(n + 100, text(50) + rows[5][1][100:230] + text(50))]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert Counter(tuple(r) for r in spans.spans(docs, buckets=5).collect()) == plain(rows)
        texts = spans._identified(docs, "doc_id", "text")
        scanned = texts.select("uid", "text").mapInArrow(spans._scan(5), spans.ROW)
        classes = scanned.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(spans._classes(5), spans.ROW)
        asked = classes.where(F.col("kind") == spans.ASK).unionByName(texts.mapInArrow(spans._blobs(5), spans.ROW)).repartition("bucket").sortWithinPartitions("bucket", "kind")
        held = asked.mapInArrow(spans._fetch(5), "key long, uid long, start long, data binary")
        largest.append(held.groupBy("key").count().agg(F.max("count")).first()[0])
    assert max(largest) <= 300


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(spans, "PIECE", 700)
    rng = random.Random(6)
    base = "".join(rng.choice("abcd") for _ in range(5000))
    rows = [(1, base), (2, base[2000:4000]), (3, base[100:180] * 40)]
    assert Counter(tuple(r) for r in spans.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == plain(rows)


def test_texts_that_remain(small):
    want = {d: (n, k) for (d, n, _, _, k) in plain([(r.doc_id, r.text) for r in small.collect()])}
    got = spans.removed(small)
    assert got.columns == small.columns
    for r in got.collect():
        n, sha = want[r.doc_id]
        if len(r.text.encode()) == n:
            assert hashlib.sha256(r.text.encode()).hexdigest() == sha
    assert got.count() == small.count()


def test_clashing_names(odd):
    names = ["uid", "rest", "row", "null", "kept_text", "n_spans", "__uid", "__null", "__kept", "__text", "data", "bucket"]
    other = odd.withColumns({n: F.lit(n) for n in names})
    out = spans.removed(other)
    assert out.columns == other.columns and all(r[n] == n for r in out.collect() for n in names)
    assert Counter(str(r) for r in out.select(*odd.columns).collect()) == Counter(str(r) for r in spans.removed(odd).collect())
    assert Counter(r.text for r in spans.removed(odd.select("doc_id", "text")).collect()) == Counter(r.text for r in spans.removed(odd).collect())


def test_empty(empty):
    assert spans.query(empty).collect() == []
    assert spans.removed(empty).collect() == []
