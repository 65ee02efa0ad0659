"""Small table operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that both tables hold."""
    return a.intersect(b.select(*a.columns))


def row_keys(df: DataFrame, columns: list[str], name: str = "key", mark: str = "_") -> DataFrame:
    """``df`` with its ``columns`` joined into one text."""
    return df.withColumn(name, F.concat_ws(mark, *[F.col(c).cast("string") for c in columns]))


def first_rows(df: DataFrame, n: int = 100) -> DataFrame:
    """At most ``n`` rows, for display."""
    return df.limit(n)


def combinations(spark: SparkSession, queries: int, references: int, kind: str = "one2one") -> DataFrame:
    """(q, r) chromosome pairs: each with its own number, or ``all2all``."""
    q = spark.range(1, queries + 1).select(F.col("id").alias("q"))
    if kind == "one2one":
        if queries != references:
            raise ValueError("one to one needs as many chromosomes on both sides")
        return q.select("q", F.col("q").alias("r"))
    if kind != "all2all":
        raise ValueError(f"unknown kind: {kind}")
    return q.select("q", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(references).cast("long"))).alias("r"))


def patterns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, n): each distinct pattern of ``columns`` with its number of rows; nulls make patterns of their own."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def heat(cells: DataFrame, by: str | None = None, binary: bool = False) -> DataFrame:
    """(row, col, value, label): the cells of a matrix, scaled to 0..1 within each ``by`` (row or col).

    ``label`` keeps the value as it was.  With ``binary`` a cell counts as 1 where it is not zero, before scaling.  A
    row or column of one value has no scale, so its cells are null; null and NaN cells stay as they are and scale nothing.
    """
    if by not in (None, "row", "col"):
        raise ValueError(f"cells scale by row or col, not by {by}")
    v = F.col("value").cast("double")
    shown = F.when(F.isnan(v) | v.isNull(), v).otherwise((v != 0).cast("double")) if binary else v
    out = cells.select("row", "col", shown.alias("value"), v.alias("label"))
    if by is None:
        return out
    real = F.when(~F.isnan("value"), F.col("value"))
    ends = out.groupBy(F.col(by).alias("__by")).agg(F.min(real).alias("__lo"), F.max(real).alias("__hi"))
    scaled = (F.col("value") - F.col("__lo")) / F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0.0))
    return out.join(ends, F.col(by).eqNullSafe(F.col("__by"))).select("row", "col", scaled.alias("value"), "label")


def shared_prefix(df: DataFrame, keys: list[str], column: str, most: int = 1000) -> DataFrame:
    """(keys, prefix): the longest common prefix, of up to ``most`` characters, of each group's texts, null ones left out.

    The first and the last text by order have no longer prefix in common than all have.
    """
    ends = df.groupBy(*keys).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    sizes = F.sequence(F.lit(0), F.least(F.length("__lo"), F.length("__hi"), F.lit(most)))
    fits = F.filter(sizes, lambda k: F.substr("__lo", F.lit(1), k) == F.substr("__hi", F.lit(1), k))
    return ends.select(*keys, F.substr("__lo", F.lit(1), F.array_max(fits)).alias("prefix"))
