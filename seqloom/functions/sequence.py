"""Column functions over sequence strings: JVM expressions, and Arrow kernels where those would go symbol by symbol."""

from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from seqloom.functions import codes
from seqloom.functions.alphabet import IUPAC, PAIRED


def complement(seq: Column) -> Column:
    """IUPAC complement; lower case becomes upper case, an unknown symbol raises."""
    s = F.upper(seq)
    bad = F.regexp_replace(s, f"[{IUPAC}]", "")
    return F.when(F.length(bad) > 0, F.raise_error(F.concat(F.lit("unknown symbol: "), bad)).cast("string")).otherwise(F.translate(s, IUPAC, PAIRED))


def rev_compl(seq: Column) -> Column:
    return F.reverse(complement(seq))


def gc_content(seq: Column) -> Column:
    """Share of G and C among all symbols, gaps included; null for an empty sequence."""
    s = F.upper(seq)
    return (F.length(s) - F.length(F.translate(s, "GC", ""))) / F.nullif(F.length(s), F.lit(0))


def let(value: Column, then) -> Column:
    """``then`` of a lambda variable that holds ``value``: the optimizer cannot move ``value`` into ``then``'s loops."""
    return F.element_at(F.transform(F.array(value), then), 1)


def split_seq(seq: Column, n: int = 5000, step: int = 0) -> Column:
    """Pieces of ``n`` symbols after the first ``step``; the last one may be shorter."""
    return F.regexp_extract_all(F.substr(seq, F.lit(step + 1)), F.lit(f"(?s).{{1,{n}}}"), F.lit(0))


def words(seq: Column, size: int) -> Column:
    """All overlapping words of ``size`` symbols, from one pass over the sequence."""
    return F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def clean(seq: Column, flank: int = 0) -> Column:
    """Without gaps and without ``flank`` symbols at both ends."""
    s = F.replace(seq, F.lit("-"), F.lit(""))
    return F.substr(s, F.lit(flank + 1), F.greatest(F.length(s) - 2 * flank, F.lit(0)))


def translate_seq(seq: Column) -> Column:
    """Amino acids of frame 0; an unknown codon is ``-``, a partial last one is ignored."""
    return codes.of_text("string", pa.string(), codes.amino)(seq)


def last_n(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def combination_ref(comb: Column) -> Column:
    """``X_Y`` to Y as a number; null if it has another form."""
    return F.when(comb.rlike(r"^\d+_\d+$"), F.split_part(comb, F.lit("_"), F.lit(2)).cast("bigint"))


def is_combination(comb: Column) -> Column:
    return comb.rlike(r"^\d+_\d+$")


def prefix_fields(name: Column) -> Column:
    """``accession_q_r`` (the accession may hold underscores) to a struct of its three fields."""
    part = lambda k: F.regexp_extract(name, r"^(.*)_([^_]+)_([^_]+)$", k)
    return F.struct(part(1).alias("acc"), part(2).alias("q"), part(3).alias("r"))


def field(text: Column, n: int, pattern: str = r"\|") -> Column:
    """The n-th field (from 1) of a split; null beyond the last."""
    return F.get(F.split(text, pattern), F.lit(n - 1))


def masks(bases: str = "ACGT") -> list[str]:
    """Every permutation of ``bases`` but the identity, in lexical order."""
    return ["".join(p) for p in permutations(bases)][1:]


def mask(seq: Column, to: str, bases: str = "ACGT") -> Column:
    """Substitute ``bases`` by ``to``; a symbol outside ``bases`` raises."""
    if sorted(set(to)) != sorted(to):
        raise ValueError("a mask must have unique values")
    s = F.upper(seq)
    bad = F.length(F.translate(s, bases, "")) > 0
    return F.when(bad, F.raise_error(F.lit("symbol outside the mask")).cast("string")).otherwise(F.translate(s, bases, to))


def inverse_mask(to: str, bases: str = "ACGT") -> str:
    return "".join(bases[to.index(b)] for b in bases)


def repeat_score(seq: Column, size: int = 11, cutoff: int = 2) -> Column:
    """Share of the words of ``size`` that occur over ``cutoff`` times; null without words."""
    return codes.of_text("double", pa.float64(), lambda text: codes.repeated_share(text, size, cutoff))(seq)


def single_symbols(seq: Column) -> Column:
    """The symbols of a sequence as an array."""
    return F.filter(F.split(seq, ""), lambda x: x != "")


def checked_symbols(symbols: Column) -> Column:
    """An array of symbols as it is; an element that is not one symbol raises."""
    bad = F.exists(symbols, lambda x: F.length(x) != 1)
    return F.when(bad, F.raise_error(F.lit("an element is not a single symbol")).cast("array<string>")).otherwise(symbols)
