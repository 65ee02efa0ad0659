from collections import Counter

import pytest
from test_mixing import plain_targets
from test_packing import check
from test_packing import whole as tokens_of
from test_shingles import plain_firsts
from test_spans import plain as plain_spans

import corpus_pipeline
from seqloom.plans.recovery import table


@pytest.fixture(scope="module")
def outputs(spark, both):
    docs, out = both, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = table(stage(spark, docs, ""), name)
        out[name] = docs
    return out


def whole(rows):
    """Rows as a multiset: ids may be null or repeated."""
    return Counter(map(str, rows))


def test_language_and_near_duplicates(both, outputs):
    worded = [r for r in both.collect() if any(c.isalpha() for c in r.text or "")]
    assert whole(outputs["language_id"].collect()) == whole(worded)
    # Each class of near copies keeps its first row: ids ascend, rows without one come last.
    place = lambda r: (r.doc_id is None, r.doc_id or 0)
    worded.sort(key=place)
    assert Counter(map(place, outputs["near_dedup"].collect())) == Counter(place(worded[i]) for i in plain_firsts([r.text for r in worded]))
    assert not whole(outputs["near_dedup"].collect()) - whole(worded)


def test_passages(outputs):
    before, after = outputs["near_dedup"].collect(), outputs["suffix_dedup"].collect()
    want = plain_spans([(r.doc_id, r.text) for r in before])
    left, kept = {}, {}
    for d, n, gone, _, _ in want.elements():
        left.setdefault(d, []).append(n - gone)
    for r in after:
        kept.setdefault(r.doc_id, []).append(len(r.text.encode()))
        assert r.n_chars == len(r.text)
    assert {d: len(x) for d, x in left.items()} == {d: len(x) for d, x in kept.items()}
    assert Counter((r.doc_id, r.source, r.lang) for r in after) == Counter((r.doc_id, r.source, r.lang) for r in before)
    for d, sizes in left.items():
        # Characters that were cut in part are lost as well.
        assert all(a - 12 <= b <= a for a, b in zip(sorted(sizes), sorted(kept[d]), strict=True))


def test_mix_and_pack(outputs):
    before, after = outputs["suffix_dedup"].collect(), outputs["mix_sources"]
    size, taken = Counter(), Counter()
    for r in before:
        size[r.source] += len(r.text.split())
    for r in after.collect():
        taken[r.source] += len(r.text.split())
    goal = plain_targets(size)
    assert sum(abs(taken[s] - goal[s]) for s in size) < 0.05 * sum(size.values())
    assert max(Counter(r.doc_id for r in after.collect()).values()) <= 3
    check(outputs["pack"].collect(), tokens_of(after), 4 * after.rdd.getNumPartitions())


def test_columns_and_empty_table(spark, both, empty, outputs):
    assert all(outputs[name].columns == both.columns for name, _ in corpus_pipeline.STAGES[:-1])
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_each_stage_on_odd_rows(spark, odd, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, odd, "")
    assert out.count() > 0
    if name != "pack":
        assert out.columns == odd.columns
    if name == "suffix_dedup":
        assert out.count() == odd.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
