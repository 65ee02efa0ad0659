import re
from collections import Counter

from pyspark.sql import functions as F

from seqloom.llm import quality

SPACE = " \t\n\x0b\x0c\r"


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if any(c not in SPACE for c in x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    chars = sum(map(len, words))
    base = len(words) < 20 or 100 * len(repeat) > 30 * len(words)
    upper, letters = sum(c.isupper() for c in text), sum(c.isalpha() for c in text)
    bad = 10 * symbols > len(words) or 2 * upper > letters or 10 * sum(any(c.isalpha() for c in w) for w in words) < 7 * len(words)
    bad = bad or not 2 * len(words) <= chars <= 15 * len(words) or 2 * len(set(lines)) < len(lines)
    return len(words), chars, symbols, len(lines) - len(set(lines)), len(repeat), base, not base and not bad


def test_against_brute_force(spark, both):
    more = spark.createDataFrame([(9000, "p q r s t u v w x " * 30, "", "", 1), (9001, "one two\n" * 40, "", "", 1), (9002, " ".join(f"w{i}" for i in range(30)) + " " + " ".join(f"w{i}" for i in range(12)), "", "", 1)], both.schema)
    docs = both.unionByName(more)
    got = Counter(tuple(r) for r in quality.query(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect())
    assert got == Counter((r.doc_id, *plain(r.text)) for r in docs.collect())


def test_order_does_not_matter(both):
    order = quality.estimate(both)
    assert {e.rule.name for e in order} == {r.name for r in quality.RULES}
    assert all(e.seconds > 0 and 0 <= e.rejected <= 1 for e in order)
    # The first rule rejects most for its cost; each later share is of the rows that are left.
    assert order[0].rejected / order[0].seconds >= max(e.rejected / e.seconds for e in order if e.rejected <= order[0].rejected)
    rows = quality.measures(both)
    a = rows.select("doc_id", quality.cascade(order, F.col("text"), F.col("words")).alias("k"))
    b = rows.select("doc_id", quality.cascade(order[::-1], F.col("text"), F.col("words")).alias("k"))
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def test_keeps_what_labels_call_clean(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = quality.query(small).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r.kept == (r.quality == 1) for r in rows)


def test_no_python_in_the_plan(small):
    plan = quality.query(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty(empty):
    assert quality.query(empty).collect() == []
