from collections import Counter

import pytest

import corpus_pipeline
from seqloom.llm import simhash


@pytest.mark.parametrize("stage", ["near_dedup", "one_of_each"])
def test_null_and_repeated_ids_are_documents(spark, stage):
    text = {c: " ".join(f"{c}{i * 7 % 50}" for i in range(40)) for c in "abcde"}
    rows = [(None, "a"), (None, "a"), (None, "b"), (7, "c"), (7, "d"), (8, "c"), (9, "e"), (None, "e")]
    docs = spark.createDataFrame([(i, text[c], "en", "s", 1) for i, c in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, "") if stage == "near_dedup" else simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text[0]) for r in kept.collect()) == Counter([(None, "a"), (None, "b"), (7, "c"), (7, "d"), (9, "e")])
