"""Every registered query of the library with its SQL counterpart.

Each query runs over the whole of the bundled tables; ``seqloom.plans.fixtures`` says how they become
sequences, alignments, intervals, hits, coordinate maps and graphs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import sequence as sq
from seqloom.functions.alphabet import AMINO
from seqloom.operators import alignment as am
from seqloom.operators import coordinates as co
from seqloom.operators import graphs as gr
from seqloom.operators import hits as ht
from seqloom.operators import intervals as iv
from seqloom.operators import kernels as ke
from seqloom.operators import modularity as mo
from seqloom.operators import orfs as of
from seqloom.operators import refine as rf
from seqloom.operators import runs as rn
from seqloom.operators import similarity as si
from seqloom.operators import variants as va
from seqloom.operators.components import connected_components
from seqloom.plans import fixtures as fx
from seqloom.registry import ORACLES, QUERIES, add, on  # noqa: F401

GENOMES = list(range(fx.ACCESSIONS))


def wide(spark: SparkSession, d: str) -> DataFrame:
    return fx.aligned(spark, d, fx.WIDE)


def cells(spark: SparkSession, d: str) -> DataFrame:
    return am.to_cells(fx.aligned(spark, d))


ALN, WIDE = fx.aligned_sql(), fx.aligned_sql(fx.WIDE)

# --- sequences -----------------------------------------------------------------------------------
_COMP = "translate(seq, 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN')"
add("rev_compl", on(fx.seqs, lambda s: s.select("name", sq.rev_compl(F.col("seq")).alias("rc"))), f"SELECT name, reverse({_COMP}) AS rc FROM seqs", "seqs")
add("complement", on(fx.seqs, lambda s: s.select("name", sq.complement(F.col("seq")).alias("comp"))), f"SELECT name, {_COMP} AS comp FROM seqs", "seqs")
add("gc_content", on(fx.seqs, lambda s: s.select("name", F.round(sq.gc_content(F.col("seq")), 9).alias("gc"))), "SELECT name, round(length(regexp_replace(seq, '[^GC]', '', 'g')) / nullif(length(seq), 0)::DOUBLE, 9) AS gc FROM seqs", "seqs")
add("split_seq", on(fx.seqs, lambda s: s.select("name", F.posexplode(sq.split_seq(F.col("seq"), 500, 7)).alias("part", "piece")).select("name", F.col("part").cast("long").alias("part"), "piece")),
    "SELECT name, k AS part, substr(seq, 8 + k * 500, 500) AS piece FROM (SELECT name, seq, unnest(range(0, (length(seq) - 8 + 500) // 500)) AS k FROM seqs WHERE length(seq) > 7)", "seqs")
add("kmer_words", on(fx.seqs, lambda s: si.kmer_counts(s, 6, []).select("w", "n")),
    "SELECT w, count(*) AS n FROM (SELECT substr(seq, i::INT, 6) AS w FROM (SELECT seq, unnest(range(1, length(seq) - 4)) AS i FROM seqs WHERE length(seq) >= 6)) GROUP BY w", "seqs")
add("repeat_score", on(fx.seqs, lambda s: s.select("name", F.round(sq.repeat_score(F.col("seq")), 9).alias("score"))), """,
 w AS (SELECT name, substr(seq, i::INT, 11) AS w FROM (SELECT name, seq, unnest(range(1, length(seq) - 9)) AS i FROM seqs WHERE length(seq) >= 11)),
 n AS (SELECT name, w, count(*) AS n FROM w GROUP BY ALL), s AS (SELECT name, round(sum(CASE WHEN n > 2 THEN n ELSE 0 END) / sum(n)::DOUBLE, 9) AS score FROM n GROUP BY name)
SELECT seqs.name, score FROM seqs LEFT JOIN s ON s.name = seqs.name""", "seqs")  # fmt: skip
add("translate_aa", on(fx.seqs, lambda s: s.select("name", sq.translate_seq(F.col("seq")).alias("aa"))), f"""SELECT name, array_to_string(list_transform(range(0, length(seq) // 3),
  lambda k: substr('{AMINO}', 16 * (instr('TCAG', substr(seq, (3 * k + 1)::INT, 1)) - 1) + 4 * (instr('TCAG', substr(seq, (3 * k + 2)::INT, 1)) - 1) + instr('TCAG', substr(seq, (3 * k + 3)::INT, 1)), 1)), '') AS aa FROM seqs""", "seqs")  # fmt: skip
add("seq_clean", on(fx.aligned, lambda a: a.select("aln", "row", sq.clean(F.col("seq"), 3).alias("clean"))), "SELECT aln, row, substr(replace(seq, '-', ''), 4, greatest(length(replace(seq, '-', '')) - 6, 0)) AS clean FROM aligned", ALN)
add("name_fields", lambda spark, d: spark.read.parquet(f"{d}/customer.parquet").select(
        "c_custkey", sq.field(F.col("c_name"), 2, "#").cast("long").alias("number"), sq.last_n(F.col("c_name"), 4).alias("tail"),
        sq.prefix_fields(F.concat_ws("_", F.lit("acc_x"), F.col("c_nationkey").cast("string"), F.lit("7"))).getField("q").alias("q"),
        sq.combination_ref(F.concat(F.col("c_nationkey").cast("string"), F.lit("_3"))).alias("ref"), sq.is_combination(F.col("c_name")).alias("ok")),
    "SELECT c_custkey, string_split(c_name, '#')[2]::BIGINT AS number, right(c_name, 4) AS tail, c_nationkey::VARCHAR AS q, 3::BIGINT AS ref, regexp_matches(c_name, '^\\d+_\\d+$') AS ok FROM customer")
add("mask_seqs", on(fx.seqs, lambda s: s.select("name", sq.mask(F.col("seq"), sq.masks()[8]).alias("masked"), sq.mask(sq.mask(F.col("seq"), sq.masks()[8]), sq.inverse_mask(sq.masks()[8])).alias("back"))),
    f"SELECT name, translate(seq, 'ACGT', '{sq.masks()[8]}') AS masked, seq AS back FROM seqs", "seqs")
add("base_content", on(fx.seqs, rn.symbol_content), "SELECT name, k AS wnd, " + ", ".join(f"round(length(regexp_replace(s, '[^{x}]', '', 'g')) / length(s)::DOUBLE, 9) AS {x.lower()}" for x in "ACGT")
    + " FROM (SELECT name, k, substr(seq, (k * 100 + 1)::INT, 100) AS s FROM (SELECT name, seq, unnest(range(0, (length(seq) + 99) // 100)) AS k FROM seqs))", "seqs")

# --- alignments ----------------------------------------------------------------------------------
_PROF = "prof AS (SELECT aln, col, " + ", ".join(f"count(*) FILTER (nt = '{x}') AS {y}" for x, y in zip([*am.NUCLEOTIDES, "-"], "acgtx", strict=True)) + " FROM mx GROUP BY aln, col)"
_BEST = "CASE greatest(a, c, g, t) WHEN a THEN 'A' WHEN c THEN 'C' WHEN g THEN 'G' ELSE 'T' END"
add("profile", on(fx.aligned, am.profile), f', {_PROF} SELECT aln, col, a, c, g, t, x AS gap FROM prof', ALN)
add("consensus", on(fx.aligned, am.consensus), f", {_PROF} SELECT aln, col, {_BEST} AS nt FROM prof", ALN)
add("consensus_n_rule", on(fx.aligned, lambda c: am.consensus(c, "N")), f", {_PROF} SELECT aln, col, CASE WHEN greatest(a, c, g, t) = 0 THEN 'N' ELSE {_BEST} END AS nt FROM prof", ALN)
add("consensus_multi", on(fx.aligned, lambda c: am.consensus_rows(c, 3)), f""", {_PROF}
SELECT aln, r AS row, string_agg(CASE WHEN round_even((a + c + g + t) / (a + c + g + t + x)::DOUBLE * 3, 0) >= r THEN {_BEST} ELSE '-' END, '' ORDER BY col) AS seq FROM prof, range(1, 4) u(r) GROUP BY aln, r""", ALN)
_RUN = "SELECT aln, row, array_to_string(list(p ORDER BY col), ',') AS pos FROM (SELECT aln, row, col, CASE WHEN nt <> '-' AND n > {f} AND n <= m - {f} THEN n - {f} ELSE 0 END AS p FROM (SELECT *, sum((nt <> '-')::INT) OVER (PARTITION BY aln, row ORDER BY col) AS n, sum((nt <> '-')::INT) OVER (PARTITION BY aln, row) AS m FROM mx)) GROUP BY aln, row"
_joined = lambda f: on(fx.aligned, lambda a: am.positions(a, f).select("aln", "row", F.array_join("pos", ",").alias("pos")))
add("aln2pos", _joined(0), _RUN.format(f=0), ALN)
add("mx2pos_flank", _joined(5), _RUN.format(f=5), ALN)
add("mx2aln", on(cells, am.to_strings), "SELECT aln, row, seq FROM aligned", ALN)
add("mx2seq", on(cells, lambda c: am.to_strings(c, False)), "SELECT aln, row, replace(seq, '-', '') AS seq FROM aligned", ALN)
add("reduce_freq", on(fx.aligned, am.frequent_columns), "SELECT aln, row, coalesce(string_agg(nt, '' ORDER BY col) FILTER (n >= 3), '') AS seq FROM (SELECT *, sum((nt <> '-')::INT) OVER (PARTITION BY aln, col) AS n FROM mx) GROUP BY aln, row", ALN)
add("reduce_flank", on(fx.aligned, lambda c: am.conserved_span(c, 3, 0.5, 3)), f""", {_PROF},
 fit AS (SELECT aln, col, col - row_number() OVER (PARTITION BY aln ORDER BY col) AS i FROM prof WHERE greatest(a, c, g, t) >= 3 AND greatest(a, c, g, t) / (a + c + g + t)::DOUBLE >= 0.5)
SELECT aln, min(b) AS first, max(e) AS last FROM (SELECT aln, min(col) AS b, max(col) AS e FROM fit GROUP BY aln, i HAVING count(*) >= 3) GROUP BY aln""", ALN)
add("msadiff", on(fx.aligned, am.difference), """SELECT m.aln, m.row, string_agg(CASE WHEN m.nt = '-' THEN 'g' WHEN r.nt = '-' OR m.nt = r.nt THEN 's' ELSE 'd' END, '' ORDER BY m.col) AS diff
FROM mx m JOIN mx r ON r.aln = m.aln AND r.col = m.col AND r.row = 0 GROUP BY m.aln, m.row""", ALN)
add("row_distances", on(wide, am.distances), """, c AS (SELECT a.aln, a.row AS i, b.row AS j, count(*) FILTER (a.nt <> '-' AND a.nt = b.nt) AS same, count(*) FILTER (a.nt <> '-' AND b.nt <> '-') AS both_, count(*) FILTER (a.nt <> '-' OR b.nt <> '-') AS e,
  count(*) FILTER (a.nt <> '-') AS ni, count(*) FILTER (b.nt <> '-') AS nj FROM mx a JOIN mx b ON a.aln = b.aln AND a.col = b.col AND a.row < b.row GROUP BY ALL)
SELECT aln, i, j, 1 - round(same / nullif(least(ni, nj), 0)::DOUBLE, 9) AS shared, round((both_ - same) / nullif(both_, 0)::DOUBLE, 9) AS p, round((e - same) / nullif(e, 0)::DOUBLE, 9) AS union_ FROM c""", WIDE)
add("bad_alignment", on(fx.aligned, am.bad_alignments), """, k AS (SELECT aln, col, (count(DISTINCT nt) FILTER (nt <> '-') <> 1)::INT AS mixed FROM mx GROUP BY aln, col),
 r AS (SELECT mx.aln, row, mx.col, mixed, mx.col - row_number() OVER (PARTITION BY mx.aln, row ORDER BY mx.col) AS run FROM mx JOIN k ON k.aln = mx.aln AND k.col = mx.col WHERE nt <> '-')
SELECT aln, max(s) > 0.2 AS bad FROM (SELECT aln, avg(mixed) AS s FROM r GROUP BY aln, row, run) GROUP BY aln""", ALN)

# --- runs and windows over events ----------------------------------------------------------------
K = ["key"]
_signed = lambda f: f.withColumn("v", F.col("flag").cast("long") * F.col("pos"))
_steps = lambda f: f.withColumn("v", F.floor(F.col("value") / 20))
add("find_ones", on(fx.flags, lambda f: rn.runs_of_ones(f, K)), "SELECT key, min(pos) AS beg, max(pos) AS \"end\", max(pos) - min(pos) + 1 AS len FROM (SELECT *, pos - row_number() OVER (PARTITION BY key ORDER BY pos) AS g FROM flags WHERE flag = 1) GROUP BY key, g", "flags")
add("find_runs", on(fx.flags, lambda f: rn.runs_of_steps(_steps(f), K)), """, s AS (SELECT key, pos, floor(value / 20)::BIGINT AS v FROM flags),
 n AS (SELECT *, CASE WHEN abs(v - lag(v) OVER (PARTITION BY key ORDER BY pos)) = 1 THEN 0 ELSE 1 END AS new FROM s), g AS (SELECT *, sum(new) OVER (PARTITION BY key ORDER BY pos) AS g FROM n)
SELECT key, min(pos) AS beg, max(pos) AS "end", count(*) AS len, arg_min(v, pos) AS v_beg, arg_max(v, pos) AS v_end FROM g GROUP BY key, g""", "flags")
add("fill_zeros", on(fx.flags, lambda f: rn.filled(_signed(f), K).select("key", "pos", "prev", "next", "fill_prev", "fill_next")), """, f AS (SELECT key, pos, last_value(nullif(flag * pos, 0) IGNORE NULLS) OVER (PARTITION BY key ORDER BY pos ROWS UNBOUNDED PRECEDING) AS prev,
 first_value(nullif(flag * pos, 0) IGNORE NULLS) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next FROM flags) SELECT *, coalesce(prev, 0) AS fill_prev, coalesce(next, 0) AS fill_next FROM f""", "flags")
add("stretches", on(fx.flags, lambda f: rn.stretches(f, K).select("key", "pos", "fwd", "bwd")), """, f AS (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM flags)
SELECT key, pos, coalesce(min(CASE WHEN flag <> 0 THEN pos END) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), n + 1) - pos - 1 AS fwd,
 pos - coalesce(max(CASE WHEN flag <> 0 THEN pos END) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 1 AS bwd FROM f""", "flags")
add("wnd_mean", on(fx.flags, lambda f: rn.window_means(f, K, 10).withColumn("mean", F.round("mean", 6))), "SELECT key, (pos - 1) // 10 AS wnd, round(avg(value), 6) AS mean FROM flags GROUP BY ALL", "flags")
add("wnd_sum", on(fx.flags, lambda f: rn.window_sums(f, K, 7).select("key", "pos", F.round("total", 6).alias("total"))), "SELECT key, pos, round(sum(value) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING), 6) AS total FROM flags", "flags")
add("pi_windows", on(fx.flags, lambda f: rn.diversity_windows(f.where("flag = 1"), K, 5).withColumn("pi", F.round("pi", 6))), "SELECT key, 5 * (row_number() OVER (PARTITION BY key ORDER BY w) - 1) AS pos, round(s / 5, 6) AS pi FROM (SELECT key, (pos + 4) // 5 AS w, sum(value) AS s FROM flags WHERE flag = 1 GROUP BY ALL)", "flags")
_LINE = lambda spark, d: spark.read.parquet(f"{d}/lineitem.parquet").select("l_partkey", "l_orderkey", "l_linenumber")
add("dup_values", on(_LINE, lambda x: rn.repeated_values(x, "l_partkey")), "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
add("dup_rows", on(_LINE, lambda x: rn.repeated_rows(x, "l_orderkey")), "SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey) > 1")

# --- intervals -----------------------------------------------------------------------------------
_MERGE = """g AS (SELECT *, sum(new) OVER (PARTITION BY key ORDER BY beg, "end" ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN beg <= max("end") OVER (PARTITION BY key ORDER BY beg, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM iv)),
 merged AS (SELECT key, min(beg) AS beg, max("end") AS "end", count(*) AS n, max("end") - min(beg) + 1 AS len FROM g GROUP BY key, g)"""
add("merge_overlaps", on(fx.intervals, lambda i: iv.merged(i, K)), f", {_MERGE} SELECT * FROM merged", "intervals")
add("union_coverage", on(fx.intervals, lambda i: iv.union_length(i, K)), f", {_MERGE} SELECT key, sum(len)::BIGINT AS covered FROM merged GROUP BY key", "intervals")
add("nested_intervals", on(fx.intervals, lambda i: iv.contained(i.distinct(), K, [])), """SELECT * FROM (SELECT key, beg, "end", max("end") OVER (PARTITION BY key ORDER BY beg, "end" DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT DISTINCT * FROM iv)) WHERE "end" <= reach""", "intervals")
add("partial_overlaps", on(fx.intervals, lambda i: iv.partial_overlaps(i.distinct(), K, [])), """, r AS (SELECT key, beg, "end" FROM (SELECT *, max("end") OVER (PARTITION BY key ORDER BY beg, "end" DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT DISTINCT * FROM iv)) WHERE reach IS NULL OR "end" > reach)
SELECT *, "end" - next_beg + 1 AS overlap FROM (SELECT *, lead(beg) OVER (PARTITION BY key ORDER BY beg) AS next_beg FROM r) WHERE next_beg <= "end" """, "intervals")
add("overlap_join", on(fx.intervals, lambda i: iv.overlap_join(i, i, K, 8).groupBy("key").agg(F.count("*").alias("n"), F.sum(F.least("end_a", "end_b") - F.greatest("beg_a", "beg_b") + 1).alias("shared"))),
    'SELECT a.key, count(*) AS n, sum(least(a."end", b."end") - greatest(a.beg, b.beg) + 1)::BIGINT AS shared FROM iv a JOIN iv b ON a.key = b.key AND a.beg <= b."end" AND b.beg <= a."end" GROUP BY a.key', "intervals")
add("containment_join", on(fx.intervals, lambda i: iv.containment_join(i, iv.merged(i, K).select("key", "beg", "end"), K, 8).groupBy("key", F.col("beg_b").alias("beg"), F.col("end_b").alias("end")).agg(F.count("*").alias("n"))), f', {_MERGE} SELECT key, beg, "end", n FROM merged', "intervals")
_DEPTH = """ev AS (SELECT key, x, sum(d)::BIGINT AS d FROM (SELECT key, beg AS x, 1 AS d FROM iv UNION ALL SELECT key, "end" + 1, -1 FROM iv) GROUP BY ALL HAVING sum(d) <> 0)"""
add("coverage_depth", on(fx.intervals, lambda i: iv.depth(i, K)), f""", {_DEPTH} SELECT * FROM (SELECT key, x AS beg, lead(x) OVER (PARTITION BY key ORDER BY x) - 1 AS "end", (sum(d) OVER (PARTITION BY key ORDER BY x))::BIGINT AS depth FROM ev) WHERE depth > 0""", "intervals")
_two = lambda i: (i.where("beg % 2 = 0"), i.where("beg % 2 = 1"))
add("block_intersect", on(fx.intervals, lambda i: iv.intersection(*_two(i), K)), """, p AS (SELECT DISTINCT key, beg % 2 AS side, unnest(range(beg, "end" + 1)) AS x FROM iv), b AS (SELECT key, x FROM p GROUP BY ALL HAVING count(*) = 2)
SELECT key, min(x) AS beg, max(x) AS "end" FROM (SELECT key, x, x - row_number() OVER (PARTITION BY key ORDER BY x) AS g FROM b) GROUP BY key, g""", "intervals")
add("nearest_flanks", lambda spark, d: iv.nearest(fx.flags(spark, d).select((1 + F.col("key") % 10).alias("key"), (F.col("pos") * 40).alias("at")).distinct(), iv.merged(fx.intervals(spark, d), K), K), f""", {_MERGE}, p AS (SELECT DISTINCT 1 + key % 10 AS key, pos * 40 AS at FROM flags)
SELECT p.key, p.at, max(m."end") FILTER (m."end" < p.at) AS before, min(m.beg) FILTER (m.beg > p.at) AS after FROM p LEFT JOIN merged m ON m.key = p.key GROUP BY ALL""", "intervals", "flags")
add("axis_expand", on(fx.intervals, lambda i: iv.expanded_axis(iv.merged(i, K), K, "n")), f', {_MERGE} SELECT *, beg + shift AS new_pos FROM (SELECT *, coalesce(sum(n) OVER (PARTITION BY key ORDER BY beg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS shift FROM merged)', "intervals")
add("grid_split", on(fx.intervals, lambda i: iv.grid(iv.merged(i, K).select("key", "beg", "end"), 4)), f""", {_MERGE} SELECT key, beg + len * k // n4 AS beg, beg + len * (k + 1) // n4 - 1 AS "end" FROM (SELECT key, beg, len, (len + 3) // 4 AS n4, unnest(range(0, (len + 3) // 4)) AS k FROM merged)""", "intervals")

# --- hits ----------------------------------------------------------------------------------------
_SIDE = """({k} AS (SELECT *, max(e) OVER (PARTITION BY q_id, s_id, strand ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM {src}))"""
_NEST = """h AS (SELECT *, CASE WHEN s_beg > s_end THEN '-' ELSE '+' END AS strand FROM hits),
 sides AS (SELECT q_id, s_id, strand, 0 AS side, q_beg AS b, q_end AS e FROM h UNION ALL SELECT q_id, s_id, strand, 1, least(s_beg, s_end), greatest(s_beg, s_end) FROM h),
 cov AS (SELECT q_id, s_id, strand, side, sum(greatest(0, e - greatest(b - 1, coalesce(r, b - 1)))) AS c FROM (SELECT *, max(e) OVER (PARTITION BY q_id, s_id, strand, side ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM sides) GROUP BY ALL),
 nest AS (SELECT q_id AS name_query, s_id AS name_target, strand, 110::BIGINT AS length_query, 350::BIGINT AS length_target, round(max(c) FILTER (side = 0) / 110.0::DOUBLE, 9) AS coverage_query, round(max(c) FILTER (side = 1) / 350.0::DOUBLE, 9) AS coverage_target FROM cov GROUP BY ALL)"""
add("nestedness", on(fx.hits, ht.nestedness_table), f", {_NEST} SELECT * FROM nest", "hits")
add("filter_nestedness", on(fx.hits, lambda h: ht.filter_nestedness(ht.nestedness_table(h), 85, 50, 400, [7])), f", {_NEST} SELECT * FROM nest WHERE name_query <> 7 AND name_target <> 7 AND greatest(coverage_query, coverage_target) >= 0.85", "hits")
add("nested_edges", on(fx.hits, lambda h: ht.nested_edges(ht.nestedness_table(h), 0.8)), f""", {_NEST} SELECT DISTINCT * FROM (SELECT name_query AS src, name_target AS dst FROM nest WHERE coverage_query >= 0.8 AND length_target / length_query::DOUBLE >= 0.8
 UNION ALL SELECT name_target, name_query FROM nest WHERE coverage_target >= 0.8 AND length_query / length_target::DOUBLE >= 0.8) WHERE src <> dst""", "hits")
add("hit_contingency", on(fx.hits, ht.contingency), "SELECT q_id, s_id, n, (sum(n) OVER (PARTITION BY q_id))::BIGINT AS total FROM (SELECT q_id, s_id, count(*) AS n FROM hits GROUP BY q_id, s_id)", "hits")
add("copy_matrix", on(fx.hits, lambda h: ht.copy_matrix(h, list(range(50)))), "SELECT q_id, " + ", ".join(f"count(*) FILTER (s_id = {g}) AS g{g}" for g in range(50)) + " FROM hits GROUP BY q_id", "hits")
add("hits_per_query", on(fx.hits, ht.hits_per_query), "SELECT round(avg(n), 9) AS mean, min(n) AS least, max(n) AS most FROM (SELECT q_id, count(*) AS n FROM hits GROUP BY q_id)", "hits")
add("aa_rescale", on(fx.hits, lambda h: ht.rescaled_to_bases(ht.sane(ht.without_self(ht.by_identity(h, 85))))), "SELECT q_id, (q_beg - 1) * 3 + 1 AS q_beg, q_end * 3 AS q_end, s_beg, s_end, pident, aln_len * 3 AS aln_len, s_id, q_len * 3 AS q_len, s_len FROM hits WHERE pident >= 85 AND q_id <> s_id", "hits")
add("glue_hits", on(fx.hits, lambda h: ht.glued(h.withColumn("q_beg", F.col("q_beg")))), """, h AS (SELECT *, CASE WHEN s_beg > s_end THEN '-' ELSE '+' END AS strand FROM hits),
 n AS (SELECT *, CASE WHEN strand = '+' AND q_beg = lag(q_end) OVER w + 1 AND s_beg = lag(s_end) OVER w + 1 THEN 0 ELSE 1 END AS new, row_number() OVER w AS k FROM h WINDOW w AS (PARTITION BY q_id, s_id, strand ORDER BY q_beg, q_end, s_beg, s_end, pident)),
 g AS (SELECT *, sum(new) OVER (PARTITION BY q_id, s_id, strand ORDER BY k) AS g FROM n)
SELECT q_id, s_id, strand, min(q_beg) AS q_beg, max(q_end) AS q_end, CASE strand WHEN '+' THEN min(s_beg) ELSE max(s_beg) END AS s_beg, CASE strand WHEN '+' THEN max(s_end) ELSE min(s_end) END AS s_end, count(*) AS n FROM g GROUP BY q_id, s_id, strand, g""", "hits")
add("hits_in_ref", on(fx.hits, lambda h: ht.merged_hits(h, 0.8, 0.3)))
add("hits_gff", on(fx.hits, lambda h: ht.to_gff(ht.merged_hits(h, 0.8, 0.3))))

# --- coordinates ---------------------------------------------------------------------------------
_RANK = "rk AS (SELECT *, (row_number() OVER (PARTITION BY chr, acc ORDER BY abs(own)) * sign(own))::BIGINT AS rank FROM pos)"
_BLOCK = _RANK + """, bl AS (SELECT *, (sum(new) OVER (PARTITION BY chr, acc ORDER BY pan))::BIGINT AS block FROM (SELECT *, CASE WHEN rank - lag(rank) OVER (PARTITION BY chr, acc ORDER BY pan) = 1 THEN 0 ELSE 1 END AS new FROM rk))"""
add("signed_blocks", on(fx.positions, co.blocks), f', {_BLOCK} SELECT chr, acc, block, min(pan) AS pan_b, max(pan) AS pan_e, arg_min(own, pan) AS own_b, arg_max(own, pan) AS own_e, count(*) AS n, sign(min(own))::INT AS dir FROM bl GROUP BY chr, acc, block', "positions")
add("merged_blocks", on(fx.positions, lambda a: co.merged_blocks(a, 20)), f""", {_BLOCK}, b AS (SELECT chr, acc, block, min(pan) AS pan_b, max(pan) AS pan_e, arg_min(own, pan) AS own_b, arg_max(own, pan) AS own_e, count(*) AS n, sign(min(own)) AS dir FROM bl GROUP BY chr, acc, block),
 m AS (SELECT *, CASE WHEN dir = lag(dir) OVER w AND pan_b - lag(pan_e) OVER w < 20 AND abs(own_b - lag(own_e) OVER w) < 20 THEN 0 ELSE 1 END AS new FROM b WINDOW w AS (PARTITION BY chr, acc ORDER BY pan_b)),
 g AS (SELECT *, sum(new) OVER (PARTITION BY chr, acc ORDER BY pan_b) AS g FROM m) SELECT chr, acc, min(pan_b) AS pan_b, max(pan_e) AS pan_e, sum(n)::BIGINT AS n FROM g GROUP BY chr, acc, g""", "positions")
add("breaks", on(fx.positions, co.breaks), f""", {_BLOCK} SELECT * FROM (SELECT chr, acc, pan AS idx_beg, lead(pan) OVER w AS idx_end, own AS val_beg, lead(own) OVER w AS val_end, abs(lead(own) OVER w - own) - 1 AS len_acc, lead(pan) OVER w - pan - 1 AS len_comb FROM bl WINDOW w AS (PARTITION BY chr, acc, block ORDER BY pan)) WHERE len_acc <> 0 OR len_comb <> 0""", "positions")
add("block_cleanup", on(fx.positions, lambda a: co.without_short_blocks(a, 60, 1)), f""", {_BLOCK} SELECT chr, acc, pan, own FROM bl QUALIFY max(pan) OVER (PARTITION BY chr, acc, block) - min(pan) OVER (PARTITION BY chr, acc, block) > 60""", "positions")
add("axis_compaction", on(fx.positions, co.compacted), "SELECT chr, acc, dense_rank() OVER (PARTITION BY chr ORDER BY pan) AS pan, own FROM pos", "positions")
add("genome_coverage", on(fx.positions, co.coverage_of), "SELECT chr, acc, count(*) AS n FROM pos GROUP BY ALL", "positions")
_genes = lambda a: a.where("acc = 1").select("chr", F.abs("own").alias("id"), F.abs("own").alias("beg"), (F.abs("own") + F.abs("own") % 7).alias("end"), F.when(F.col("own") % 2 == 0, "+").otherwise("-").alias("strand"))
_MAP = _BLOCK + """, items AS (SELECT chr, abs(own) AS id, abs(own) AS beg, abs(own) + abs(own) % 7 AS "end", CASE WHEN own % 2 = 0 THEN '+' ELSE '-' END AS strand FROM pos WHERE acc = 1),
 m AS (SELECT a.chr, abs(a.own) AS x, b.own * sign(a.own) AS y, b.block FROM pos a JOIN bl b ON a.chr = b.chr AND a.pan = b.pan AND a.acc = 1 AND b.acc = 2)"""
_LIFT = """SELECT chr, id, beg, "end", strand, beg2::BIGINT AS beg2, end2::BIGINT AS end2, strand2, (end2 - beg2 + 1)::BIGINT AS len_new, round((end2 - beg2 + 1) / ("end" - beg + 1)::DOUBLE, 2) AS len_ratio FROM (SELECT *, CASE WHEN yb < 0 THEN abs(ye) ELSE yb END AS beg2, CASE WHEN yb < 0 THEN abs(yb) ELSE ye END AS end2,
 CASE WHEN yb >= 0 THEN strand WHEN strand = '+' THEN '-' ELSE '+' END AS strand2 FROM f WHERE sign(yb * ye) = 1 AND bb = be) WHERE beg2 <= end2"""
add("liftover_exact", on(fx.positions, lambda a: co.lift(_genes(a), a, 1, 2)), f""", {_MAP}, f AS (SELECT i.*, b.y AS yb, e.y AS ye, b.block AS bb, e.block AS be FROM items i JOIN m b ON b.chr = i.chr AND b.x = i.beg JOIN m e ON e.chr = i.chr AND e.x = i."end") {_LIFT}""", "positions")
add("liftover_nearest", on(fx.positions, lambda a: co.lift(_genes(a), a, 1, 2, False)), f""", {_MAP}, f AS (SELECT i.*, b.y AS yb, e.y AS ye, b.block AS bb, e.block AS be FROM items i ASOF JOIN m b ON b.chr = i.chr AND b.x >= i.beg ASOF JOIN m e ON e.chr = i.chr AND e.x <= i."end") {_LIFT}""", "positions")
add("region_positions", on(fx.positions, lambda a: co.region(a, 1, 3, 5, 90)), "SELECT chr, acc, pan, own FROM pos WHERE chr = 1 AND pan BETWEEN (SELECT min(pan) FROM pos WHERE chr = 1 AND acc = 3 AND abs(own) IN (5, 90)) AND (SELECT max(pan) FROM pos WHERE chr = 1 AND acc = 3 AND abs(own) IN (5, 90)) AND (SELECT count(*) FROM pos WHERE chr = 1 AND acc = 3 AND abs(own) IN (5, 90)) = 2", "positions")
add("two_ref_concordance", on(fx.positions, lambda a: co.concordant(a, 0, 1)), """, f AS (SELECT a.chr, a.acc, a.pan, (a.own * sign(r0.own))::BIGINT AS own, CASE WHEN r1.own IS NULL THEN 1 ELSE 2 END AS trust FROM pos a JOIN pos r0 ON r0.acc = 0 AND r0.chr = a.chr AND r0.pan = a.pan LEFT JOIN pos r1 ON r1.acc = 1 AND r1.chr = a.chr AND r1.pan = a.pan
 WHERE a.acc NOT IN (0, 1) AND (r1.own IS NULL OR sign(r0.own) = sign(r1.own))) SELECT * FROM f QUALIFY count(*) OVER (PARTITION BY chr, acc, own) = 1""", "positions")

# --- variants ------------------------------------------------------------------------------------
_SNP = "sp AS (SELECT chr, pan FROM nts GROUP BY ALL HAVING count(DISTINCT nt) > 1), here AS (SELECT nts.* FROM nts SEMI JOIN sp ON sp.chr = nts.chr AND sp.pan = nts.pan)"
_CONS = "cn AS (SELECT chr, pan, " + ", ".join(f"count(*) FILTER (nt = '{x}') AS {x.lower()}" for x in "ACGT") + " FROM nts GROUP BY chr, pan)"
add("pan_consensus", on(fx.bases, lambda b: va.consensus(b, 8)), f", {_CONS} SELECT *, 8 - a - c - g - t AS gap, {_BEST} AS nt FROM cn", "positions", "bases")
add("snp_positions", on(fx.bases, va.snp_positions), f", {_SNP} SELECT * FROM sp", "positions", "bases")
add("snp_matrix", on(fx.bases, lambda b: va.snp_matrix(b, GENOMES)), f""", {_SNP}, {_CONS} SELECT sp.chr, sp.pan, k AS acc, CASE WHEN h.nt IS NULL THEN -1 WHEN h.nt <> {_BEST} THEN 1 ELSE 0 END AS state
FROM sp JOIN cn ON cn.chr = sp.chr AND cn.pan = sp.pan CROSS JOIN range(8) u(k) LEFT JOIN here h ON h.chr = sp.chr AND h.pan = sp.pan AND h.acc = k""", "positions", "bases")
add("vcf_rows", on(fx.bases, lambda b: va.vcf(b, GENOMES)), f""", {_SNP}, {_CONS},
 own AS (SELECT chr, pan, list(nt ORDER BY acc) AS l FROM here GROUP BY ALL),
 r AS (SELECT own.chr, own.pan, l, coalesce((SELECT nt FROM here h WHERE h.chr = own.chr AND h.pan = own.pan AND h.acc = 0), {_BEST}) AS ref FROM own JOIN cn ON cn.chr = own.chr AND cn.pan = own.pan),
 al AS (SELECT chr, pan, ref, list_reduce(list_filter(l, lambda x: x <> ref), lambda a, x: CASE WHEN contains(a, x) THEN a ELSE a || x END) AS alts FROM r),
 gt AS (SELECT al.chr, al.pan, ref, alts, k, CASE WHEN h.nt IS NULL THEN './.' WHEN h.nt = ref THEN '0/0' ELSE instr(alts, h.nt)::VARCHAR || '/' || instr(alts, h.nt)::VARCHAR END AS gt FROM al CROSS JOIN range(8) u(k) LEFT JOIN here h ON h.chr = al.chr AND h.pan = al.pan AND h.acc = k)
SELECT chr::VARCHAR AS chrom, pan AS pos, ref, array_to_string(string_split(alts, ''), ',') AS alt, string_agg(gt, chr(9) ORDER BY k) AS gts FROM gt GROUP BY chr, pan, ref, alts""".replace("chr(9)", "'\t'"), "positions", "bases")
add("site_pi", on(fx.bases, va.site_pi), "SELECT chr, pan, round(1 - sum(2 * k * (2 * k - 1)) / (sum(2 * k) * (sum(2 * k) - 1))::DOUBLE, 9) AS pi FROM (SELECT chr, pan, nt, count(*) AS k FROM nts GROUP BY ALL) GROUP BY chr, pan", "positions", "bases")
add("snp_distance", on(fx.bases, va.snp_distance), f", {_SNP} SELECT a.acc AS i, b.acc AS j, count(*) FILTER (a.nt <> b.nt) AS d, count(*) AS n FROM here a JOIN here b ON a.chr = b.chr AND a.pan = b.pan AND a.acc < b.acc GROUP BY ALL", "positions", "bases")
_GAPS = _RANK + """, gaps AS (SELECT chr, acc, pan + 1 AS beg, np - 1 AS "end" FROM (SELECT *, lead(pan) OVER w AS np, lead(rank) OVER w AS nr FROM rk WINDOW w AS (PARTITION BY chr, acc ORDER BY pan)) WHERE np > pan + 1 AND nr - rank = 1),
 lack AS (SELECT chr, x, count(*) AS n FROM (SELECT chr, unnest(range(beg, "end" + 1)) AS x FROM gaps) GROUP BY ALL),
 sg AS (SELECT chr, greatest(min(x) - 1, 1) AS beg, least(max(x) + 1, (SELECT max(pan) FROM pos p WHERE p.chr = l.chr)) AS "end", count(*) AS len FROM (SELECT chr, x, x - row_number() OVER (PARTITION BY chr ORDER BY x) AS g FROM lack) l GROUP BY chr, g)"""
add("sv_coverage", on(fx.positions, lambda a: va.sv_coverage(a).select("chr", F.explode(F.sequence("beg", "end")).alias("pan"), "depth")), f", {_GAPS} SELECT chr, x AS pan, n AS depth FROM lack", "positions")
add("sv_groups", on(fx.positions, va.sv_groups), f', {_GAPS} SELECT chr, beg, "end", len FROM sg', "positions")
_GENO = _GAPS + """, bo AS (SELECT chr, beg AS pan, 0.1::DOUBLE AS e FROM sg UNION ALL SELECT chr, "end", -0.1::DOUBLE FROM sg),
 br AS (SELECT bo.chr, acc, bo.pan, e, own, row_number() OVER (PARTITION BY bo.chr, acc ORDER BY abs(own + e)) * sign(own) AS r FROM bo JOIN pos ON pos.chr = bo.chr AND pos.pan = bo.pan),
 gn AS (SELECT sg.chr, sg.beg, sg."end", len, b.acc, b.own AS own_b, f.own AS own_e, abs(b.own - f.own) - 1 AS len_acc FROM sg JOIN br b ON b.e > 0 AND b.chr = sg.chr AND b.pan = sg.beg JOIN br f ON f.e < 0 AND f.chr = sg.chr AND f.pan = sg."end" AND f.acc = b.acc WHERE f.r - b.r = 1 AND b.own * f.own > 0),
 geno AS (SELECT * FROM gn QUALIFY max(len_acc) OVER (PARTITION BY chr, beg, "end") <= len)"""
add("sv_genotypes", on(fx.positions, va.sv_genotypes), f", {_GENO} SELECT * FROM geno", "positions")
_CLASS = _GENO + """, ct AS (SELECT chr, beg, "end", len, count(*) FILTER (len_acc >= 0.9::DOUBLE * len) AS freq_max, count(*) FILTER (len_acc <= (1 - 0.9::DOUBLE) * len) + 8 - count(*) AS freq_min FROM geno GROUP BY ALL),
 cs AS (SELECT *, freq_min + freq_max AS freq_sum, (freq_min + freq_max = 8)::INT AS single FROM ct WHERE NOT (freq_min + freq_max = 8 AND (freq_min = 0 OR freq_max = 0))),
 cls AS (SELECT chr, beg, "end", len, freq_min, freq_max, freq_sum, single, 'SVgr_' || chr || '_id_' || lpad((row_number() OVER (PARTITION BY chr ORDER BY beg, "end"))::VARCHAR, 6, '0') || '|' || len AS name,
  CASE WHEN single = 0 THEN 'complex' WHEN freq_max <= 0.1 * 8 THEN 'insertion' WHEN freq_max >= 0.9 * 8 THEN 'deletion' ELSE 'indel' END AS type FROM cs)"""
_classes = lambda a: va.sv_classes(va.sv_genotypes(a), 8)
add("sv_classes", on(fx.positions, _classes), f", {_CLASS} SELECT * FROM cls", "positions")
add("sv_size_table", on(fx.positions, lambda a: va.sv_size_table(_classes(a), (0, 1, 2, 3, 5))), f", {_CLASS} SELECT above, count(*) AS n, sum(1 - single)::BIGINT AS complex, sum(single)::BIGINT AS simple, round(sum(single) / count(*)::DOUBLE, 2) AS ratio FROM cls, (VALUES (0), (1), (2), (3), (5)) t(above) WHERE len > above GROUP BY above", "positions")
add("sv_len_freq", on(fx.positions, lambda a: va.sv_length_by_frequency(_classes(a), (1, 2, 3, 5))), f""", {_CLASS}, b AS (SELECT CASE WHEN len >= 5 THEN '[5,)' WHEN len >= 3 THEN '[3,5)' WHEN len >= 2 THEN '[2,3)' ELSE '[1,2)' END AS bin, freq_max AS freq, count(*) AS n FROM cls WHERE single = 1 GROUP BY ALL) SELECT bin, freq, n, round(n / (sum(n) OVER (PARTITION BY freq))::DOUBLE, 9) AS share FROM b""", "positions")
add("sv_gff", on(fx.positions, lambda a: va.sv_gff(g := va.sv_genotypes(a), va.sv_classes(g, 8))), f""", {_CLASS} SELECT g.chr, acc, least(abs(own_b), abs(own_e)) + 1 AS beg, greatest(abs(own_b), abs(own_e)) - 1 AS "end", CASE WHEN own_b < 0 THEN '-' ELSE '+' END AS strand, name FROM geno g JOIN cls ON cls.chr = g.chr AND cls.beg = g.beg AND cls."end" = g."end" WHERE len_acc > 0""", "positions")

# --- reading frames ------------------------------------------------------------------------------
_AA = lambda s: f"array_to_string(list_transform(range(0, length({s}) // 3), lambda k: substr('{AMINO}', 16 * (instr('TCAG', substr({s}, (3 * k + 1)::INT, 1)) - 1) + 4 * (instr('TCAG', substr({s}, (3 * k + 2)::INT, 1)) - 1) + instr('TCAG', substr({s}, (3 * k + 3)::INT, 1)), 1)), '')"
_SPLIT = """pc AS (SELECT *, string_split(aa, '*') AS l FROM fr), pe AS (SELECT * EXCLUDE (l, aa), unnest(l) AS aa, unnest(range(1, len(l) + 1)) AS k FROM pc),
 po AS (SELECT *, coalesce(sum(length(aa) + 1) OVER (PARTITION BY name, strand, shift ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pe),
 orf AS (SELECT name, strand, shift, CASE strand WHEN '+' THEN b ELSE n - b + 1 END AS beg, CASE strand WHEN '+' THEN e ELSE n - e + 1 END AS "end", e - b + 1 AS len, length(aa) AS aalen, aa FROM (SELECT *, (3 * before + 1 + shift)::BIGINT AS b, (3 * (before + length(aa)) + shift)::BIGINT AS e FROM po WHERE length(aa) >= 25))"""
add("orf_frame0", on(fx.seqs, of.frame_zero), f""", fr AS (SELECT name, '+' AS strand, 0 AS shift, length(seq) AS n, {_AA('seq')} AS aa FROM seqs), {_SPLIT} SELECT name, beg, "end", aa FROM orf""", "seqs")
_SIX = f"""st AS (SELECT name, '+' AS strand, length(seq) AS n, seq AS s FROM seqs UNION ALL SELECT name, '-', length(seq), reverse(translate(seq, 'ACGT', 'TGCA')) FROM seqs),
 ft AS (SELECT name, strand, n, k AS shift, substr(s, (k + 1)::INT) AS f FROM st, range(3) u(k)), fr AS (SELECT name, strand, shift, n, {_AA('f')} AS aa FROM ft), {_SPLIT}"""
add("orf_six_frame", on(fx.seqs, of.six_frames), f", {_SIX} SELECT * FROM orf", "seqs")
add("orf_best", on(fx.seqs, lambda s: of.best(of.six_frames(s), 2)), f""", {_SIX} SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY name ORDER BY len DESC, strand, shift, beg))::INT AS rank FROM orf) WHERE rank <= 2""", "seqs")

# --- graphs --------------------------------------------------------------------------------------
add("shortcut_edges", on(fx.edges, gr.shortcuts), "SELECT DISTINCT e.src, e.dst FROM edges e JOIN edges a ON a.src = e.src JOIN edges b ON b.src = a.dst AND b.dst = e.dst", "edges")
add("without_shortcuts", on(fx.edges, gr.without_shortcuts), "SELECT src, dst FROM edges EXCEPT SELECT e.src, e.dst FROM edges e JOIN edges a ON a.src = e.src JOIN edges b ON b.src = a.dst AND b.dst = e.dst", "edges")
_CC = """und AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges), walk(node, label) AS (SELECT a, a FROM und UNION SELECT und.b, walk.label FROM walk JOIN und ON und.a = walk.node WHERE und.b > walk.label), comp AS (SELECT node, min(label) AS component FROM walk GROUP BY node)"""
add("components", on(fx.edges, connected_components), f", {_CC} SELECT * FROM comp", "edges")
add("component_sizes", on(fx.edges, gr.component_sizes), f", {_CC} SELECT component, count(*) AS n FROM comp GROUP BY component", "edges")
add("degrees", on(fx.edges, gr.degrees), "SELECT node, sum(i)::BIGINT AS n_in, sum(o)::BIGINT AS n_out FROM (SELECT src AS node, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) GROUP BY node", "edges")
_SCC = """reach(a, b) AS (SELECT src, dst FROM edges UNION SELECT reach.a, edges.dst FROM reach JOIN edges ON edges.src = reach.b), nd AS (SELECT src AS name FROM edges UNION SELECT dst FROM edges),
 scc AS (SELECT nd.name, least(nd.name, min(r.b)) AS node FROM nd LEFT JOIN (SELECT r.a, r.b FROM reach r JOIN reach s ON s.a = r.b AND s.b = r.a) r ON r.a = nd.name GROUP BY nd.name)"""
add("scc_nodes", on(fx.edges, gr.strong_components), f", {_SCC} SELECT * FROM scc", "edges")
add("scc_compact", on(fx.edges, lambda e: gr.condensed(e, gr.strong_components(e))), f", {_SCC} SELECT a.node AS src, b.node AS dst, count(*) AS n, count(DISTINCT e.src) AS n_src, count(DISTINCT e.dst) AS n_dst FROM edges e JOIN scc a ON a.name = e.src JOIN scc b ON b.name = e.dst WHERE a.node <> b.node GROUP BY ALL", "edges")
_tens = lambda e: e.select(F.explode(F.array("src", "dst")).alias("name")).distinct().withColumn("node", F.floor(F.col("name") / 4))
add("dominant_edges", on(fx.edges, lambda e: gr.dominant(e, _tens(e), 0.5)), """, nd AS (SELECT name, name // 4 AS node FROM (SELECT src AS name FROM edges UNION SELECT dst FROM edges)), sz AS (SELECT node, count(*) AS s FROM nd GROUP BY node),
 c AS (SELECT a.node AS src, b.node AS dst, count(*) AS n, count(DISTINCT e.src) AS n_src, count(DISTINCT e.dst) AS n_dst FROM edges e JOIN nd a ON a.name = e.src JOIN nd b ON b.name = e.dst WHERE a.node <> b.node GROUP BY ALL)
SELECT c.* FROM c JOIN sz x ON x.node = c.src JOIN sz y ON y.node = c.dst WHERE n_src / x.s::DOUBLE >= 0.5 AND n_dst / y.s::DOUBLE >= 0.5""", "edges")
add("leaf_peel", on(fx.edges, gr.peeled))
add("bridges", on(fx.edges, gr.bridges))
add("attribute_nodes", on(fx.edges, lambda e: gr.attributed(e, connected_components(gr.without_shortcuts(e)), 0.6)))
add("families", on(fx.edges, gr.families))
add("communities", on(fx.edges, gr.communities))
add("modular_communities", on(fx.edges, mo.modular_communities))

# --- similarity ----------------------------------------------------------------------------------
_DOTS = """wx AS (SELECT id, s1, s2, unnest(range(1, length(s1) - 4)) AS i FROM pairs WHERE length(s1) >= 6), wy AS (SELECT id, s1, s2, i, unnest(range(1, length(s2) - 4)) AS j FROM wx WHERE length(s2) >= 6),
 dots AS (SELECT id, i, j, n FROM (SELECT id, i, j, 6 - hamming(substr(s1, i::INT, 6), substr(s2, j::INT, 6)) AS n FROM wy) WHERE n >= 4)"""
add("dot_matches", on(fx.pairs_of_text, lambda p: si.dots(p, 6, 4)), f", {_DOTS} SELECT * FROM dots", "pairs")
add("dot_cover", on(fx.pairs_of_text, lambda p: si.dot_cover(p, 6, 4)), f", {_DOTS} SELECT pairs.id, round(coalesce(k, 0) / greatest(length(s1) - 5, 1)::DOUBLE, 9) AS cover FROM pairs LEFT JOIN (SELECT id, count(DISTINCT i) AS k FROM dots GROUP BY id) d ON d.id = pairs.id", "pairs")
add("dot_score", on(fx.pairs_of_text, lambda p: si.dot_score(p, 6, 4)), f", {_DOTS} SELECT pairs.id, round(coalesce(k, 0) / nullif((length(s1) + length(s2)) / 2.0::DOUBLE, 0), 9) AS score FROM pairs LEFT JOIN (SELECT id, count(*) AS k FROM dots GROUP BY id) d ON d.id = pairs.id", "pairs")
_KMER = """ug AS (SELECT aln, row, replace(seq, '-', '') AS s FROM aligned WHERE replace(seq, '-', '') <> ''), kw AS (SELECT aln, row, w, count(*) AS n FROM (SELECT aln, row, substr(s, i::INT, 7) AS w FROM (SELECT aln, row, s, unnest(range(1, length(s) - 5)) AS i FROM ug WHERE length(s) >= 7)) GROUP BY ALL),
 pr AS (SELECT a.aln, a.row AS i, b.row AS j, greatest(length(a.s), length(b.s)) AS l FROM ug a JOIN ug b ON a.aln = b.aln AND a.row < b.row),
 df AS (SELECT aln, i, j, l, w, n, 0 AS m FROM pr JOIN kw USING (aln) WHERE kw.row = pr.i UNION ALL SELECT aln, i, j, l, w, 0, n FROM pr JOIN kw USING (aln) WHERE kw.row = pr.j),
 kd AS (SELECT pr.aln, pr.i, pr.j, round(coalesce(d, 0) / l::DOUBLE, 9) AS d FROM pr LEFT JOIN (SELECT aln, i, j, sum(abs(x)) AS d FROM (SELECT aln, i, j, w, sum(n - m) AS x FROM df GROUP BY ALL) GROUP BY ALL) q ON q.aln = pr.aln AND q.i = pr.i AND q.j = pr.j)"""
add("kmer_distance", on(wide, si.kmer_distance), f", {_KMER} SELECT * FROM kd", WIDE)
add("kmer_clusters", on(wide, lambda r: si.clusters(si.kmer_distance(r), 0.9)), f""", {_KMER}, un AS (SELECT aln, i AS a, j AS b FROM kd WHERE d <= 0.9 UNION SELECT aln, j, i FROM kd WHERE d <= 0.9), wk(aln, node, label) AS (SELECT aln, a, a FROM un UNION SELECT wk.aln, un.b, wk.label FROM wk JOIN un ON un.aln = wk.aln AND un.a = wk.node WHERE un.b > wk.label),
 rw AS (SELECT aln, i AS row FROM kd UNION SELECT aln, j FROM kd) SELECT rw.aln, rw.row, coalesce(c, rw.row) AS cluster FROM rw LEFT JOIN (SELECT aln, node, min(label) AS c FROM wk GROUP BY ALL) x ON x.aln = rw.aln AND x.node = rw.row""", WIDE)
add("row_extremes", on(fx.vectors, lambda v: v.groupBy("row").agg(F.max("value").alias("hi"), F.min("value").alias("lo"))), "SELECT row, max(value) AS hi, min(value) AS lo FROM vec GROUP BY row", "vectors")
add("col_extremes", on(fx.vectors, lambda v: v.groupBy("col").agg(F.max("value").alias("hi"), F.min("value").alias("lo"))), "SELECT col, max(value) AS hi, min(value) AS lo FROM vec GROUP BY col", "vectors")

# --- sequential kernels --------------------------------------------------------------------------
add("clean_overlaps", on(fx.hits, ke.clean_overlaps))
add("greedy_chain", on(fx.hits, ke.greedy_chains))
add("shortest_chain", on(fx.hits, ke.shortest_chains))
add("solve_long", on(fx.intervals, lambda i: ke.solve_long(i, 8)))
add("pairwise_align", on(fx.pairs_of_text, ke.pairwise))
add("local_msa", on(fx.pairs_of_text, lambda p: ke.star_alignments(p.select("id", F.explode(F.array("s1", "s2", F.concat("s1", "s2"))).alias("seq")))))
add("mask_unaligned", on(fx.aligned, ke.mask_unaligned))
add("best_chromosome", on(fx.positions, lambda a: ke.best_chromosomes(a, 5)))


def _near(spark: SparkSession, d: str) -> DataFrame:
    """(aln, i, j, d): word distances of the rows of each alignment."""
    return si.kmer_distance(wide(spark, d))


def _sides(rows: DataFrame) -> DataFrame:
    """(id, side, row, seq): each alignment's odd and even rows as alignments of their own."""
    return rows.select(F.col("aln").alias("id"), (F.col("row") % 2 + 1).alias("side"), "row", "seq")


add("dendrogram", on(_near, lambda n: rf.dendrogram(n).withColumn("height", F.round("height", 9))))
add("leaf_order", on(_near, rf.leaf_order))
add("linkage_clusters", on(_near, lambda n: rf.linkage_clusters(n, 0.9)))
add("merged_profiles", on(fx.aligned, lambda a: rf.merged_profiles(_sides(a))))
add("shared_blocks", on(fx.aligned, lambda a: rf.shared_blocks(rf.merged_profiles(_sides(a)))))
add("refined_alignments", on(fx.pairs_of_text, lambda p: rf.refined_alignments(p.select("id", F.posexplode(F.array("s1", "s2", F.concat("s1", "s2"), F.concat("s2", "s1"))).alias("row", "seq")))))
