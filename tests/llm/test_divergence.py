import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqloom.llm import divergence, terms

PATTERN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(a): b for a, b in zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", strict=True)}


def plain(docs, least=10, top=10):
    """Rows by every pair of groups and every kept term, for docs (lang, source, text)."""
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        words = PATTERN.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        df[lang].update(set(words))
        count[lang, source].update(words)
    share = lambda c, n, v: 1 + 1_000_000_000 * (c + 2) // (n + 2 * v)
    apart = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(count[lang, s][t], total[s], len(kept)) for t in kept} for s in sources}
        whole = {t: share(sum(count[lang, s][t] for s in sources), sum(total.values()), len(kept)) for t in kept}
        for a in sources:
            pair = [(sum(apart(p[a][t], p[b][t]) for t in kept), b) for b in sources if b != a]
            term = [(apart(p[a][t], whole[t]), t) for t in kept if count[lang, a][t] and p[a][t] > whole[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, a, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.collect()))


def of(df):
    return [(r.lang, r.source, r.text) for r in df.collect()]


def test_terms():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("aZz09 .,-_@[`{\x7f\x00\n\té€😀İK  ") for _ in range(rng.randrange(30)))
        assert [t.decode() for t in terms.terms(text.encode(), terms.LETTERS)] == PATTERN.findall(text.translate(LOWER))


@pytest.mark.parametrize("least", [1, 10, 10_000])
def test_against_plain(both, least):
    got = rows(divergence.audit(both, least))
    assert got == plain(of(both), least) and any(r[2] == "pair" for r in got) and any(r[2] == "term" for r in got) == (least < 10_000)


def test_workers_pass_counts_on(both, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    assert rows(divergence.audit(both, 3)) == plain(of(both), 3)


def test_large_counts():
    """Products beyond 64 bits stay exact."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    row = spark.range(1).select(divergence.share(F.lit(4 * 10**15), F.lit(9 * 10**15 + 1), F.lit(10**6)).alias("p")).first()
    assert row.p == 1 + 10**9 * (4 * 10**15 + 2) // (9 * 10**15 + 1 + 2 * 10**6)


def test_hot_group(spark):
    """Most rows are copies in one group; other groups hold a term or none."""
    hot = [("en", "s0", "tide tide river")] * 400
    rest = [("en", f"s{k % 7}", f"river w{k % 5} {'tide' if k % 3 else ''}") for k in range(60)] + [("en", "none", "123 456"), ("en", "empty", None), (None, None, "tide"), ("de", "only", "x " * 40)]
    docs = spark.createDataFrame(hot + rest, "lang string, source string, text string").repartition(5)
    assert rows(divergence.query(docs)) == plain(of(docs))


def test_odd_and_empty(odd, empty):
    clash = odd.withColumn("term", F.lit("x")).withColumn("p", F.lit(1)).withColumn("item", F.lit("y"))
    assert rows(divergence.query(clash)) == plain(of(odd))
    assert divergence.query(empty).collect() == []
