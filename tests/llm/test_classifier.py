import zlib

import numpy as np
import pytest

from seqloom.llm import classifier


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    got = {r.doc_id: r for r in classifier.query(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    # A few hundred labels; see the README for what more give.
    assert np.mean([[(x > y) + 0.5 * (x == y) for y in bad] for x in good]) >= 0.92
    assert np.mean([(s >= 0.3) == q for s, q in held]) >= 0.94


def test_scores_are_the_vote_of_all_labelled_texts(tables):
    docs, labels = tables
    model = classifier.learn(docs, labels)
    texts = [r.text.encode() for r in docs.limit(40).collect()]
    vec = model._unit((classifier.counts(texts) * model.rarity - model.mean) @ model.project)
    for v, s in zip(vec, model.score(texts), strict=True):
        near = sorted(zip((model.points @ v).tolist(), model.labels.tolist(), strict=True), reverse=True)[: classifier.NEIGHBOURS]
        w = [max(c, 0) ** 4 + 1e-6 for c, _ in near]
        assert s == pytest.approx(sum(a * b[1] for a, b in zip(w, near, strict=True)) / sum(w), abs=1e-3)


def test_held_out_labels_are_not_seen(tables):
    docs, labels = tables
    from pyspark.sql import functions as F

    from seqloom.llm.common import remainder

    other = labels.withColumn("quality", F.when(remainder(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = classifier.learn(docs, labels), classifier.learn(docs, other)
    assert (a.labels == b.labels).all() and np.allclose(a.points, b.points)


def test_long_texts_count_whole(spark, monkeypatch):
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"abcZ9 .\n\xc3\xa9"), n)) for n in (0, 1, 2, 50, 3000, 700, 5)]
    want = classifier.counts(texts)
    for chunk in (1, 7, 640):
        monkeypatch.setattr(classifier, "CHUNK", chunk)
        assert np.allclose(classifier.counts(texts), want)
    monkeypatch.undo()
    assert all(np.allclose(classifier.counts([t])[0], w) for t, w in zip(texts, want, strict=True))
    # The marks of a label stand at the ends of texts of 200,000 characters; ids repeat.
    long = "plain words " * 17000
    rows = [(i, long + ("good " * 3000 if i % 2 else "#$% " * 3000)) for i in range(40)] + [(3, None), (3, "~")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in classifier.classify(docs, classifier.learn(docs, labels)).collect() if r.doc_id != 3}
    assert all((s > 0.5) == (i % 2 == 1) for i, s in got.items())


def test_odd_and_empty(odd, empty, tables):
    model = classifier.learn(*tables)
    rows = classifier.classify(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert classifier.query(empty, tables[1]).collect() == []
    assert {r.score for r in classifier.classify(odd, classifier.learn(empty, tables[1])).collect()} == {0.5}
