"""Deterministic sequence, alignment, interval, hit and graph tables made from the bundled tables.

Each is made from all rows and whole texts.  ``SQL`` holds the same recipes for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqloom.functions.sequence import split_seq

LETTERS = "abcdefghijklmnopqrstuvwxyz"
CYCLED = ("ACGT" * 7)[:26]
WIDTH = 100
WIDE = 1000
ACCESSIONS = 8


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def seqs(spark: SparkSession, d: str) -> DataFrame:
    """(name, seq): the letters of each document over ACGT."""
    text = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return _read(spark, d, "documents").select(F.col("doc_id").alias("name"), F.translate(text, LETTERS, CYCLED).alias("seq"))


def aligned(spark: SparkSession, d: str, width: int = WIDTH) -> DataFrame:
    """(aln, row, seq): each document as an alignment of its pieces of ``width``; other characters are gaps."""
    text = F.regexp_replace(F.lower("text"), "[^a-z]", "-")
    gapped = F.translate(text, LETTERS, CYCLED)
    rows = _read(spark, d, "documents").select(F.col("doc_id").alias("aln"), gapped.alias("g")).where(F.length("g") > 0)
    rows = rows.select("aln", F.posexplode(split_seq(F.col("g"), width)).alias("row", "piece"))
    return rows.select("aln", F.col("row").cast("long").alias("row"), F.rpad("piece", width, "-").alias("seq"))


def positions(spark: SparkSession, d: str) -> DataFrame:
    """(chr, acc, pan, own): a correspondence of coordinates with gaps and inverted segments."""
    o = _read(spark, d, "orders").select(
        (F.col("o_custkey") % 3).alias("chr"), (F.col("o_orderkey") % ACCESSIONS).alias("acc"), "o_orderdate", "o_orderkey", (F.col("o_orderstatus") != "F").alias("here")
    )
    by = Window.partitionBy("chr", "acc").orderBy("o_orderdate", "o_orderkey")
    o = o.withColumn("pan", F.row_number().over(by).cast("long"))
    o = o.withColumn("c", F.sum(F.col("here").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, 0))).where("here")
    o = o.withColumn("seg", F.floor((F.col("pan") - 1) / 50))
    seg = Window.partitionBy("chr", "acc", "seg")
    own = F.when(F.col("seg") % 5 == 3, -(F.min("c").over(seg) + F.max("c").over(seg) - F.col("c"))).otherwise(F.col("c"))
    return o.select("chr", "acc", "pan", own.alias("own"))


def bases(spark: SparkSession, d: str) -> DataFrame:
    """(chr, acc, pan, own, nt): positions with a base each."""
    p, a = F.col("pan"), F.col("acc")
    k = (p * 7 + F.floor(p / 3) + F.when((p * (a + 3)) % 13 == 0, a).otherwise(F.lit(0))) % 4
    return positions(spark, d).withColumn("nt", F.substr(F.lit("ACGT"), (k + 1).cast("int"), F.lit(1)))


def flags(spark: SparkSession, d: str) -> DataFrame:
    """(key, pos, flag, value): each user's events in time order."""
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = _read(spark, d, "events")
    return e.select(F.col("user_id").alias("key"), F.row_number().over(by).cast("long").alias("pos"), (F.col("event_type") == "signup").cast("int").alias("flag"), "value")


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """(key, beg, end): narrow intervals of each supplier."""
    n = F.floor(F.col("l_quantity") / 10)
    return _read(spark, d, "lineitem").select(F.col("l_suppkey").alias("key"), F.col("l_partkey").alias("beg"), (F.col("l_partkey") + n).alias("end"))


def hits(spark: SparkSession, d: str) -> DataFrame:
    """(q_id, q_beg, q_end, s_beg, s_end, pident, aln_len, s_id, q_len, s_len): a similarity-search table."""
    n = F.col("l_quantity").cast("long")
    q = F.col("l_partkey") % 60 + 1
    s = F.col("l_orderkey") % 300 + 1
    back = F.col("l_returnflag") == "R"
    return _read(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("q_id"), q.alias("q_beg"), (q + n - 1).alias("q_end"),
        F.when(back, s + n - 1).otherwise(s).alias("s_beg"), F.when(back, s).otherwise(s + n - 1).alias("s_end"),
        (80 + 20 * (1 - 10 * F.col("l_discount"))).alias("pident"), n.alias("aln_len"),
        (F.col("l_partkey") % 50).alias("s_id"), F.lit(110).cast("long").alias("q_len"), F.lit(350).cast("long").alias("s_len"),
    )


def edges(spark: SparkSession, d: str) -> DataFrame:
    """(src, dst): one link a customer, and the links that shorten two of them."""
    o = _read(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_orderkey").alias("s"))
    n = _read(spark, d, "customer").count()
    one = o.select(F.col("o_custkey").alias("src"), (1 + F.col("s") % n).alias("dst"))
    two = one.alias("a").join(one.alias("b"), F.col("a.dst") == F.col("b.src")).where("a.src % 3 <> 0").select("a.src", "b.dst")
    return one.unionByName(two).where("src <> dst").distinct()


def pairs_of_text(spark: SparkSession, d: str) -> DataFrame:
    """(id, s1, s2): each part's name and type over ACGT."""
    to = lambda c: F.translate(F.regexp_replace(F.lower(c), "[^a-z]", ""), LETTERS, CYCLED)
    return _read(spark, d, "part").select(F.col("p_partkey").alias("id"), to("p_name").alias("s1"), to("p_type").alias("s2"))


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """(row, col, value): the embeddings in long form."""
    return _read(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "value")).select("row", F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"))


_T = f"'{LETTERS}','{CYCLED}'"
SQL = {
    "seqs": f"seqs AS (SELECT doc_id AS name, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), {_T}) AS seq FROM documents)",
    "positions": f"""ord AS (SELECT o_custkey % 3 AS chr, o_orderkey % {ACCESSIONS} AS acc, row_number() OVER w AS pan, o_orderstatus <> 'F' AS here,
  (sum((o_orderstatus <> 'F')::INT) OVER w)::BIGINT AS c FROM orders WINDOW w AS (PARTITION BY o_custkey % 3, o_orderkey % {ACCESSIONS} ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)),
 pos AS (SELECT chr, acc, pan, CASE WHEN ((pan - 1) // 50) % 5 = 3 THEN -(min(c) OVER s + max(c) OVER s - c) ELSE c END AS own
  FROM ord WHERE here WINDOW s AS (PARTITION BY chr, acc, (pan - 1) // 50))""",
    "bases": "nts AS (SELECT *, substr('ACGT', (1 + (pan * 7 + pan // 3 + CASE WHEN (pan * (acc + 3)) % 13 = 0 THEN acc ELSE 0 END) % 4)::INT, 1) AS nt FROM pos)",
    "flags": "flags AS (SELECT user_id AS key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, (event_type = 'signup')::INT AS flag, value FROM events)",
    "intervals": "iv AS (SELECT l_suppkey AS key, l_partkey AS beg, l_partkey + floor(l_quantity / 10)::BIGINT AS \"end\" FROM lineitem)",
    "hits": """hits AS (SELECT l_suppkey AS q_id, q AS q_beg, q + n - 1 AS q_end, CASE WHEN b THEN s + n - 1 ELSE s END AS s_beg, CASE WHEN b THEN s ELSE s + n - 1 END AS s_end,
  pident, n AS aln_len, s_id, 110::BIGINT AS q_len, 350::BIGINT AS s_len FROM (SELECT l_suppkey, l_partkey % 60 + 1 AS q, l_orderkey % 300 + 1 AS s, l_quantity::BIGINT AS n,
  l_returnflag = 'R' AS b, 80 + 20 * (1 - 10 * l_discount) AS pident, l_partkey % 50 AS s_id FROM lineitem))""",
    "edges": """e1 AS (SELECT o_custkey AS src, (1 + sum(o_orderkey) % (SELECT count(*) FROM customer))::BIGINT AS dst FROM orders GROUP BY o_custkey),
 edges AS (SELECT DISTINCT src, dst FROM (SELECT * FROM e1 UNION ALL SELECT a.src, b.dst FROM e1 a JOIN e1 b ON a.dst = b.src WHERE a.src % 3 <> 0) WHERE src <> dst)""",
    "pairs": f"pairs AS (SELECT p_partkey AS id, translate(regexp_replace(lower(p_name), '[^a-z]', '', 'g'), {_T}) AS s1, translate(regexp_replace(lower(p_type), '[^a-z]', '', 'g'), {_T}) AS s2 FROM part)",
    "vectors": "vec AS (SELECT vec_id AS row, (i - 1)::BIGINT AS col, embedding[i]::DOUBLE AS value FROM embeddings, range(1, 65) t(i))",
}


def aligned_sql(width: int = WIDTH) -> str:
    return f"""gapped AS (SELECT doc_id AS aln, translate(regexp_replace(lower(text), '[^a-z]', '-', 'g'), {_T}) AS g FROM documents),
 aligned AS (SELECT aln, r AS row, rpad(substr(g, r * {width} + 1, {width}), {width}, '-') AS seq FROM (SELECT aln, g, unnest(range(0, (length(g) - 1) // {width} + 1)) AS r FROM gapped WHERE length(g) > 0)),
 mx AS (SELECT aln, row, i AS col, substr(seq, i::INT, 1) AS nt FROM aligned, range(1, {width + 1}) t(i))"""
