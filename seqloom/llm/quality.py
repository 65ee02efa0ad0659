"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

``measures`` adds the base numbers; ``cascade`` is a chain of conditions that ends at the
first rule that rejects.  Before the run, ``estimate`` measures on a sample of rows that pass the
base what each rule costs and which of them it rejects, and puts first the rule that rejects most for its
cost, then the one that does so among the rows that are left, and so on.  The order never changes a
verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import WORD
from seqloom.plans.recovery import cut

SPAN = 8  # words in a window
#: Rows of the planning sample and bytes of each of them, at most, and how often a rule runs over it when it is timed.
SAMPLE, LONGEST, TIMES, ENOUGH = 256, 32 << 10, 64, 0.1


def _let(value: Column, then) -> Column:
    """``then`` of a variable that holds ``value``, computed once for each row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _repeated(words: Column) -> Column:
    """Words that lie in ``SPAN``-word windows found twice or more in ``words``."""

    def count(hashes: Column) -> Column:
        # Equal windows stand side by side; the starts of such windows, ascending, cover up
        # to SPAN words each, less where the next one begins earlier.
        def starts(sorted_: Column) -> Column:
            same = lambda i: F.get(sorted_, i)["h"]
            flagged = F.filter(sorted_, lambda x, i: (F.coalesce(same(i - 1) == x["h"], F.lit(False))) | F.coalesce(same(i + 1) == x["h"], F.lit(False)))
            return F.array_sort(F.transform(flagged, lambda x: x["i"]))

        def covered(at: Column) -> Column:
            each = F.transform(at, lambda p, k: F.least(F.lit(SPAN), F.coalesce(F.get(at, k + 1) - p, F.lit(SPAN))))
            return F.aggregate(each, F.lit(0).cast("long"), lambda a, n: a + n)

        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(_let(_let(ordered, starts), covered))

    # A window is held by the 64-bit hash of its words' 64-bit hashes.
    window = lambda own: F.transform(F.slice(own, 1, F.size(own) - (SPAN - 1)), lambda _, i: F.xxhash64(F.slice(own, i + 1, SPAN)))
    return F.when(F.size(words) <= SPAN, F.lit(0).cast("long")).otherwise(_let(_let(F.transform(words, lambda w: F.xxhash64(w)), window), count))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words); a null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), 0))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    return rows.select(
        "doc_id", "text", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("words")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """A name and, of the text and its words, the condition under which a text is rejected."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _symbols(text: Column, words: Column) -> Column:
    return 10 * F.regexp_count(text, F.lit(r"[#*$%&|<>]")) > F.size(words)


def _shouting(text: Column, words: Column) -> Column:
    return 2 * F.regexp_count(text, F.lit(r"\p{Lu}")) > F.regexp_count(text, F.lit(r"\p{L}"))


def _few_letters(text: Column, words: Column) -> Column:
    return 10 * F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))) < 7 * F.size(words)


def _word_length(text: Column, words: Column) -> Column:
    return ~F.length(F.array_join(words, "")).between(2 * F.size(words), 15 * F.size(words))


def _same_lines(text: Column, words: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return _let(lines, lambda x: 2 * F.size(F.array_distinct(x)) < F.size(x))


#: More than one symbol in ten words; most letters upper-case; under 70% of words with a letter;
#: a mean word of under 2 or over 15 characters; over half of the lines repeat others.
RULES = (Rule("symbols", _symbols), Rule("shouting", _shouting), Rule("few_letters", _few_letters), Rule("word_length", _word_length), Rule("same_lines", _same_lines))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample: int = SAMPLE) -> list[Estimate]:
    """The rules in the order in which they are to run, with their time on a row and the share that each rejects of what those before it leave.

    The sample holds up to ``sample`` texts that pass the base, of up to LONGEST bytes, which the driver
    can hold; it decides on the order of rules and on nothing else.  A rule is timed over one copy of the sample, then four, and so
    on up to TIMES, until that takes ENOUGH seconds more than a pass that evaluates none.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    some = docs.select(text.alias("text")).where((F.octet_length("text") <= LONGEST) & (F.pmod(F.xxhash64("text"), F.lit(8)) == 0))
    passing = measures(some.withColumn("doc_id", F.lit(0))).where(~base_failed()).select("text").head(sample)
    if not passing:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    rows = docs.sparkSession.createDataFrame(passing, "text string").coalesce(1)
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), 0))
    verdicts = rows.select(*[r.rejects(F.col("text"), F.col("words")).alias(f"r{i}") for i, r in enumerate(rules)]).collect()
    held = cut(rows)

    def seconds(condition: Column, copies: int) -> float:
        # The condition holds the copy's number, so that no copy's work is shared with another's.
        many = held.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        began = time.perf_counter()
        many.agg(F.count_if(condition & (F.col("copy") > 0))).first()
        return time.perf_counter() - began

    idle = min(seconds(F.size("words") < 0, 1) for _ in range(3))

    def cost(rule: Rule) -> float:
        copies = 1
        while (took := seconds(rule.rejects(F.col("text"), F.col("words")), copies) - idle) < ENOUGH and copies < TIMES:
            copies *= 4
        return max(took, 1e-4) / (copies * len(passing))

    cost = [cost(r) for r in rules]
    out, left, rest = [], verdicts, list(range(len(rules)))
    while rest:
        share = {i: sum(bool(v[i]) for v in left) / max(1, len(left)) for i in rest}
        best = max(rest, key=lambda i: (share[i] / cost[i], -cost[i], -i))
        out.append(Estimate(rules[best], cost[best], share[best]))
        left = [v for v in left if not v[best]]
        rest.remove(best)
    return out


def cascade(order: list[Estimate], text: Column, words: Column) -> Column:
    """True if no rule rejects; a rule is evaluated only where those before it did not reject."""
    chain = F.lit(True)
    for e in reversed(order):
        chain = F.when(e.rule.rejects(text, words), F.lit(False)).otherwise(chain)
    return chain


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), one row for each row.

    Null and empty texts have no words and fail.  Nothing is shuffled, and no row's
    verdict depends on another row.
    """
    order = estimate(docs, rules, text_col)
    rows = measures(docs, id_col, text_col).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(order, F.col("text"), F.col("words")))
    return rows.withColumn("kept", kept).drop("text", "words")


def query(docs: DataFrame) -> DataFrame:
    return judge(docs).withColumn("doc_id", F.col("doc_id").cast("long"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, range(8) t(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, text, words, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
  AND NOT 10 * n_symbols > n_words
  AND NOT 2 * length(regexp_replace(text, '\P{Lu}', '', 'g')) > length(regexp_replace(text, '\P{L}', '', 'g'))
  AND NOT 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 7 * n_words
  AND word_chars BETWEEN 2 * n_words AND 15 * n_words
  AND NOT 2 * len(list_distinct(lines)) < len(lines) AS kept
FROM m
"""
