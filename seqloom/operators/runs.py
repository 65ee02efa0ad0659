"""Runs, fills and windows over an ordered axis; every partition key is the axis's own key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _by(keys: list[str], pos: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(pos)


def _back(keys: list[str], pos: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.desc(pos))


def runs_of_ones(df: DataFrame, keys: list[str], pos: str = "pos", flag: str = "flag") -> DataFrame:
    """(keys, beg, end, len): maximal runs of consecutive positions with flag 1; other values than 0 and 1 raise."""
    checked = F.when(~F.col(flag).isin(0, 1), F.raise_error(F.lit("flags must be 0 or 1")).cast("int")).otherwise(F.col(flag))
    ones = df.where(checked == 1)
    ones = ones.withColumn("__run", F.col(pos) - F.row_number().over(_by(keys, pos)))
    runs = ones.groupBy(*keys, "__run").agg(F.min(pos).alias("beg"), F.max(pos).alias("end")).drop("__run")
    return runs.withColumn("len", F.col("end") - F.col("beg") + 1)


def runs_of_steps(df: DataFrame, keys: list[str], pos: str = "pos", value: str = "v") -> DataFrame:
    """(keys, beg, end, len, v_beg, v_end): maximal runs in which neighbouring values differ by exactly 1 either way."""
    by = _by(keys, pos)
    new = F.when(F.abs(F.col(value) - F.lag(value).over(by)) == 1, 0).otherwise(1)
    marked = df.withColumn("__new", new).withColumn("__run", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "__run").agg(
        F.min(pos).alias("beg"), F.max(pos).alias("end"), F.count("*").alias("len"), F.min_by(value, pos).alias("v_beg"), F.max_by(value, pos).alias("v_end")
    ).drop("__run")


def previous(by: WindowSpec, value: Column) -> Column:
    """The last non-zero value at or before each row; null before the first."""
    return F.last(F.nullif(value, F.lit(0)), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))


def following(back: WindowSpec, value: Column) -> Column:
    """The first non-zero value at or after each row; ``back`` reads the axis backwards, as a frame up to the last row would be read anew for each row."""
    return previous(back, value)


def filled(df: DataFrame, keys: list[str], pos: str = "pos", value: str = "v") -> DataFrame:
    """``df`` with prev and next (zeros filled from before and after; null at undefined edges), fill_prev and fill_next (0 there)."""
    df = df.withColumns({"prev": previous(_by(keys, pos), F.col(value)), "next": following(_back(keys, pos), F.col(value))})
    return df.withColumns({"fill_prev": F.coalesce("prev", F.lit(0)), "fill_next": F.coalesce("next", F.lit(0))})


def stretches(df: DataFrame, keys: list[str], pos: str = "pos", value: str = "flag", of: int = 0) -> DataFrame:
    """``df`` with fwd and bwd: how many rows with value ``of`` follow and precede each row without a break."""
    by = _by(keys, pos)
    n = F.row_number().over(by)
    other = F.when(F.col(value) != of, n)
    before = F.max(other).over(by.rowsBetween(Window.unboundedPreceding, -1))
    total = F.count("*").over(Window.partitionBy(*keys))
    df = df.withColumns({"__n": n, "__total": total, "bwd": (n - F.coalesce(before, F.lit(0)) - 1).cast("long")})
    after = F.min(F.when(F.col(value) != of, F.col("__n"))).over(Window.partitionBy(*keys).orderBy(F.desc("__n")).rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("fwd", (F.coalesce(after, F.col("__total") + 1) - F.col("__n") - 1).cast("long"))
    return df.select(*[c for c in df.columns if c not in ("__n", "__total", "fwd", "bwd")], "fwd", "bwd")


def window_means(df: DataFrame, keys: list[str], size: int, pos: str = "pos", value: str = "value") -> DataFrame:
    """(keys, wnd, mean): means of ``size`` consecutive positions; a last partial window stays."""
    return df.groupBy(*keys, F.floor((F.col(pos) - 1) / size).alias("wnd")).agg(F.avg(value).alias("mean"))


def window_sums(df: DataFrame, keys: list[str], size: int, pos: str = "pos", value: str = "value") -> DataFrame:
    """``df`` with total: the sum over each row and the ``size`` - 1 rows after it, as far as there are any."""
    return df.withColumn("total", F.sum(value).over(_by(keys, pos).rowsBetween(0, size - 1)))


def diversity_windows(df: DataFrame, keys: list[str], size: int, pos: str = "pos", value: str = "value") -> DataFrame:
    """(keys, pos, pi): sums of fixed windows over the window length, numbered over the windows that have rows."""
    sums = df.groupBy(*keys, F.ceil(F.col(pos) / size).alias("w")).agg((F.sum(value) / size).alias("pi"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("w")) - 1
    return sums.select(*keys, (number * size).cast("long").alias("pos"), "pi")


def repeated_values(df: DataFrame, value: str) -> DataFrame:
    """Distinct values that occur more than once, with their counts."""
    return df.groupBy(value).agg(F.count("*").alias("n")).where("n > 1")


def repeated_rows(df: DataFrame, value: str) -> DataFrame:
    """All rows whose value occurs more than once."""
    return df.join(repeated_values(df, value).select(value), value, "left_semi")


def symbol_content(df: DataFrame, size: int = 100, seq: str = "seq") -> DataFrame:
    """(name, wnd, a, c, g, t): shares of the four bases in each window of ``size``."""
    pieces = F.regexp_extract_all(seq, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    parts = df.select("name", F.posexplode(pieces).alias("wnd", "s"))
    share = lambda x: F.round(F.length(F.regexp_replace("s", f"[^{x}]", "")) / F.length("s"), 9).alias(x.lower())
    return parts.select("name", F.col("wnd").cast("long").alias("wnd"), *[share(x) for x in "ACGT"])
