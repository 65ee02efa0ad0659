import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import lexical, terms

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(a): b for a, b in zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", strict=True)}


def cut(text):
    return PATTERN.findall((text or "").translate(LOWER))


def plain(docs, items, k=20):
    """(item_id, rank, doc_id, score) for rows (id, text), by scoring every document for every item."""
    bags = [(d, Counter(cut(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t in cut(text) if t in b)
            if s > 0:
                scores.append((-s, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_terms():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("aZz09 .,-_@[`{\x7f\x00\n\té€😀İK  ") for _ in range(rng.randrange(30)))
        assert [t.decode() for t in terms.terms(text.encode(), terms.ALNUM)] == cut(text)


def test_bytes_of_sevens():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 1 << b, 200) for b in (1, 7, 8, 14, 21, 28, 32)] + [np.array([0, 127, 128, (1 << 35) - 1])])
    data, end = lexical.packed(values)
    assert lexical.unpacked(data.tobytes()).tolist() == values.tolist() and end[-1] == len(data)
    assert lexical.unpacked(lexical.packed(np.zeros(0, dtype=np.int64))[0].tobytes()).tolist() == []


@pytest.mark.parametrize("seed", range(40))
def test_merge(seed):
    """The pruned merge gives what adding up every list gives, ties and a limit included."""
    rng = random.Random(seed)
    lists = []
    for _ in range(rng.randrange(0, 12)):
        docs = sorted(rng.sample(range(200), rng.randrange(0, 150)))
        lists.append((docs, [rng.randrange(1, rng.choice([3, 50, 1000])) for _ in docs]))
    total, k, limit = Counter(), rng.randrange(1, 25), rng.choice([0, 0, 40, 700])
    for docs, gains in lists:
        for d, g in zip(docs, gains, strict=True):
            total[d] += g
    want = sorted(((s, d) for d, s in total.items() if s > limit), key=lambda x: (-x[0], x[1]))[:k]
    assert lexical.best(lists, k, limit) == want


def test_frequent_lists_leave_the_merge():
    """Documents that only a frequent light term holds are not scored once k better ones are known."""
    class Read(list):
        n = 0

        def __getitem__(self, at):
            Read.n += 1
            return list.__getitem__(self, at)

    frequent = (Read(range(50_000)), [1] * 50_000)
    rare = (list(range(0, 1000, 10)), [1000] * 100)
    assert len(lexical.best([frequent, rare], 20)) == 20
    assert Read.n < 2000


@pytest.mark.parametrize("block", [3, 256])
def test_against_plain(spark, both, block):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rare = [(9001, "the the The and zz9 tide"), (9002, None), (9003, ""), (9004, "qqqqq"), (None, "größe élan"), (9001, "the the The and zz9 tide")]
    items = items.select("item_id", "text").union(spark.createDataFrame(rare, "item_id long, text string"))
    want = plain([(r.doc_id, r.text) for r in both.collect()], [(r.item_id, r.text) for r in items.collect()])
    # Small shards: many of them, and long texts that are a shard of their own.
    found = lexical.search(lexical.index(both, shard=2000), items, block=block)
    assert rows(found) == want
    assert rows(lexical.query(both.repartition(5), items)) == want


def test_hot_texts(spark):
    """One text many times, and one word in every document: ties go by id over all shards."""
    docs = spark.range(3000).select((F.col("id") * 7 % 3000).alias("doc_id"), F.when(F.col("id") % 3 == 0, "tide river tide").otherwise(F.concat(F.lit("river w"), F.col("id") % 50)).alias("text")).repartition(6)
    items = spark.createDataFrame([(1, "tide"), (2, "river"), (3, "w7 river")], "item_id long, text string")
    found = lexical.search(lexical.index(docs, shard=1000), items)
    assert rows(found) == plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_odd_and_empty(spark, odd, empty):
    items = spark.createDataFrame([(1, "a b c", 1)], "item_id long, text string, doc_id int")
    clash = odd.withColumn("shard", F.lit("x")).withColumn("term", F.lit("y"))
    assert rows(lexical.query(clash, items)) == plain([(r.doc_id, r.text) for r in odd.collect()], [(1, "a b c")])
    assert lexical.query(empty, items).collect() == [] and lexical.query(odd, items.limit(0)).collect() == []
    assert lexical.query(odd.withColumn("text", F.lit(None).cast("string")), items).collect() == []
