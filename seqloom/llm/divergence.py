"""How far apart the sources of a language are, and by which terms.

Each language keeps the terms that stand in at least ``LEAST`` of its documents.  A group (language, source), and the language as a
whole, gives each kept term p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two of them differ in a term by
floor((p - q)^2 / (p + q)).

Most counts of most groups are zero.  So a pair of groups starts at V times the difference of two zero counts, and the postings of
the terms (the groups that hold one) correct this: where one group has a count, by the difference of that count to a zero; where
both have one, by what the two corrections miss.  Corrections of one side depend on the count alone, so terms
of one count are one row.  Terms are ranked by windows that keep ten rows before they are shuffled.

Null texts, languages and sources are ''; each row is a document, repeated rows too.  A language without kept terms has
pairs of value 0 and no terms; an empty table gives no rows.  Counts are 64-bit, products of them decimals of 38 digits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import give_back, if_small, sliced
from seqloom.llm.terms import LETTERS, sql_terms, terms
from seqloom.plans.recovery import cut, table

LEAST = 10
TOP = 10
#: Counts that a worker holds before it passes them on.
HELD = 500_000


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of two positive numbers."""
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count among ``total`` occurrences of ``kept`` terms."""
    whole = F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return _div(whole, F.greatest(total + 2 * kept, F.lit(1)).cast("decimal(20,0)")) + 1


def apart(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def counted(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, added up where the texts lie and then by term."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in found.items():
                names = list(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array([source] * len(names), pa.string()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()), pa.array([d[t] for t in names], pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )
            found.clear()

        held = 0
        for batch in sliced(batches, 2):
            for lang, source, text in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                words = terms(text, LETTERS)
                n, d = found.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                n.update(words)
                d.update(set(words))
                held += len(n)
                if held > HELD:
                    yield from rows()
                    held = 0
        yield from rows()
        give_back()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    rows = docs.select(*named, F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(kernel, "lang string, source string, term string, n long, docs long")
    return rows.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` for each other source of the language, ``term`` for the source's ``top`` terms."""
    by_term = Window.partitionBy("lang", "term")
    counts = counted(docs, lang_col, source_col, text_col).withColumn("all_docs", F.sum("docs").over(by_term)).withColumn("all_n", F.sum("n").over(by_term))
    kept = table(counts.where(F.col("all_docs") >= least).select("lang", "source", "term", "n", "all_n"), "kept-terms")
    names = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    langs = kept.groupBy("lang").agg(F.countDistinct("term").alias("v"), F.sum("n").alias("all_total"))
    zero = F.lit(0).cast("long")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "v", "all_total")])
    groups = cut(groups.withColumn("p0", share(zero, F.col("total"), F.col("v"))))
    postings = kept.join(if_small(groups), ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))

    q = share(F.col("all_n"), F.col("all_total"), F.col("v"))
    words = postings.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))

    def sided(df: DataFrame, side: str, *columns: str) -> DataFrame:
        return df.select("lang", *[F.col(c).alias(f"{side}_{c}") for c in columns])

    a, b = (if_small(sided(groups, side, "source", "p0", "v")) for side in ("a", "b"))
    f00 = apart(F.col("a_p0"), F.col("b_p0"))
    base = a.join(b, "lang").where("a_source < b_source").select("lang", "a_source", "b_source", (F.col("a_v") * f00).alias("value"))
    # One side: terms of one count in a group differ alike from a zero of each other group.
    levels = sided(postings.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms")), "a", "source", "p", "p0", "terms").join(b, "lang").where("a_source <> b_source")
    one = levels.select("lang", F.least("a_source", "b_source").alias("a_source"), F.greatest("a_source", "b_source").alias("b_source"), (F.col("a_terms") * (apart(F.col("a_p"), F.col("b_p0")) - f00)).alias("value"))
    # Both sides: the two corrections counted each other's group as a zero.
    left, right = (postings.select("lang", "term", *[F.col(c).alias(f"{side}_{c}") for c in ("source", "p", "p0")]) for side in ("a", "b"))
    met = left.join(right, ["lang", "term"]).where("a_source < b_source")
    miss = apart(F.col("a_p"), F.col("b_p")) - apart(F.col("a_p"), F.col("b_p0")) - apart(F.col("a_p0"), F.col("b_p")) + f00
    both = met.select("lang", "a_source", "b_source", miss.alias("value")).where("value <> 0")
    values = cut(base.unionByName(one).unionByName(both).groupBy("lang", "a_source", "b_source").agg(F.sum("value").alias("value")))
    part = F.lit("pair").alias("part")
    pairs = values.select("lang", F.col("a_source").alias("source"), part, F.col("b_source").alias("item"), "value").unionByName(values.select("lang", F.col("b_source").alias("source"), part, F.col("a_source").alias("item"), "value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(words.withColumn("rank", rank).where(F.col("rank") <= top))


def query(docs: DataFrame) -> DataFrame:
    return audit(docs)


_PATTERN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def _p(count: str, total: str, kept: str) -> str:
    return f"(1 + (1000000000 * CAST({count} + 2 AS HUGEINT)) // greatest({total} + 2 * {kept}, 1))"


def _f(p: str, q: str) -> str:
    return f"((({p} - {q}) * ({p} - {q})) // ({p} + {q}))"


ORACLE = f"""
WITH doc AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
word AS (SELECT id, lang, source, unnest({sql_terms('text', _PATTERN)}) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
grp AS (SELECT DISTINCT lang, source FROM doc),
cnt AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM word w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term),
lng AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY lang),
tot AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM cnt GROUP BY lang, source),
cell AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_p('coalesce(c.n, 0)', 'coalesce(t.total, 0)', 'l.v')} AS p, {_p('k.n', 'l.total', 'l.v')} AS q
  FROM grp g JOIN kept k USING (lang) JOIN lng l USING (lang) LEFT JOIN tot t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
summed AS (SELECT a.lang, a.source, b.source AS item, CAST(sum({_f('a.p', 'b.p')}) AS BIGINT) AS value FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
words AS (SELECT lang, source, 'term' AS part, term AS item, CAST({_f('p', 'q')} AS BIGINT) AS value FROM cell WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM words) x)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""
