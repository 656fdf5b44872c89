"""Queries over intervals, spacing, reports and reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe import bindings as B
from locusframe import intervals as I
from locusframe import qc as Q
from locusframe import sources as IO
from locusframe import spacing as W
from locusframe.registry import query, table

CALLS, GENO, ALN, IVL, DEP, READ, SEQ = (f"WITH {x}" for x in (B.CALLS, B.GENO, B.ALN, B.IVL, B.DEP, B.READ, B.SEQ))
POS = f"WITH {B.OBS}, p AS (SELECT DISTINCT contig, pos FROM obs)"
IN = "EXISTS (SELECT 1 FROM ivl i WHERE i.contig = x.contig AND x.pos BETWEEN i.lo AND i.hi)"


def positions(spark, d):
    return B.observations(spark, d).select("contig", "pos").distinct()


@query("j02_mask_join", f"{POS}, {B.IVL} SELECT contig, pos FROM p x WHERE NOT {IN}")
def j02(spark, d):
    return I.outside(positions(spark, d), B.intervals(spark, d))


@query("j02b_mask_join_binned", f"{POS}, {B.IVL} SELECT contig, pos, {IN} AS masked FROM p x")
def j02b(spark, d):
    return I.flagged(positions(spark, d), B.intervals(spark, d), few=False)


@query("j03_region_join", f"{POS}, {B.IVL} SELECT contig, pos FROM p x WHERE {IN}")
def j03(spark, d):
    return I.inside(positions(spark, d), B.intervals(spark, d))


UNION = """o AS (SELECT contig, lo, hi, max(hi) OVER (PARTITION BY contig ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM ivl),
isl AS (SELECT *, sum(CASE WHEN lo <= m + {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM o),
u AS (SELECT contig, min(lo) AS lo, max(hi) AS hi FROM isl GROUP BY contig, k)"""


@query("w08_interval_union", f"{IVL}, {UNION.format(gap=1)} SELECT contig, lo, hi FROM u")
def w08(spark, d):
    return I.union(B.intervals(spark, d), bin_size=10_000)


EXT = "ext AS (SELECT contig, max(pos) AS len FROM obs GROUP BY contig)"


@query(
    "w09_interval_complement",
    f"""WITH {B.OBS}, {EXT}, {B.IVL}, {UNION.format(gap=1)}, g AS (
  SELECT e.contig, 1 AS lo, coalesce(min(u.lo) - 1, min(e.len)) AS hi, min(e.len) AS len FROM ext e LEFT JOIN u ON u.contig = e.contig GROUP BY e.contig
  UNION ALL SELECT u.contig, u.hi + 1, coalesce(lead(u.lo) OVER (PARTITION BY u.contig ORDER BY u.lo) - 1, e.len), e.len FROM u JOIN ext e ON u.contig = e.contig)
SELECT contig, lo, least(hi, len) AS hi FROM g WHERE lo <= least(hi, len)""",
)
def w09(spark, d):
    return I.complement(B.intervals(spark, d), Q.extents(B.observations(spark, d)))


@query("w10_soft_merge", f"{IVL}, {UNION.format(gap=501)} SELECT contig, lo, hi FROM u")
def w10(spark, d):
    return I.soft_merge(B.intervals(spark, d), flank=500)


@query("w11_region_chunks", f"WITH {B.OBS}, {EXT} SELECT contig, lo, least(lo + 9999 + 100, len) AS hi FROM (SELECT contig, len, unnest(range(1, len + 1, 10000)) AS lo FROM ext)")
def w11(spark, d):
    return I.tiles(Q.extents(B.observations(spark, d)), 10_000, 100)


@query("a22_contig_extents", f"WITH {B.OBS}, {EXT} SELECT contig, len FROM ext")
def a22(spark, d):
    return Q.extents(B.observations(spark, d))


@query("f16_hit_filter", "SELECT 'c' || (p_partkey % 4) AS contig, p_partkey % 500 + (p_partkey % 7) * 1000 AS lo, p_partkey % 500 + p_size * 3 + (p_partkey % 7) * 1000 AS hi FROM part WHERE p_partkey % 101 >= 50 AND (p_size % 10) / 100.0::DOUBLE <= 0.05")
def f16(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(F.concat(F.lit("c"), k % 4).alias("contig"), (k % 500 + F.col("p_size") * 3).alias("start"), (k % 500).alias("stop"), (k % 7 * 1000).alias("offset"), (k % 101).alias("identity"), ((F.col("p_size") % 10) / 100.0).alias("e"))
    return I.hits(rows)


@query("f17_read_filter", f"{READ}, {B.IVL} SELECT sample, contig, pos, mapq FROM rds x WHERE mapped AND mapq >= 4 AND {IN}")
def f17(spark, d):
    return I.inside(Q.mapped_reads(B.reads(spark, d)), B.intervals(spark, d)).select("sample", "contig", "pos", "mapq")


@query("k05_interval_sink", f"{IVL}, {UNION.format(gap=1)} SELECT contig, lo, hi, contig || ':' || lo AS name FROM u ORDER BY ALL")
def k05(spark, d):
    path = IO.scratch(spark, "intervals")
    IO.interval_rows(I.union(B.intervals(spark, d))).write.csv(path, sep="\t")
    return spark.read.csv(path, sep="\t", schema="contig string, lo long, hi long, name string").orderBy("contig", "lo", "hi")


NUM = f"{POS}, n AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY contig) AS n, lead(pos, 2) OVER w - pos AS ahead, lag(pos) OVER w AS prev, lead(pos) OVER w - pos AS gap FROM p WINDOW w AS (PARTITION BY contig ORDER BY pos))"


@query(
    "w01_density_filter",
    f"""{NUM}, t AS (SELECT contig, max(pos) - max(pos) FILTER (i = n - 4) AS span FROM n GROUP BY contig)
SELECT n.contig, n.pos FROM n JOIN t USING (contig) WHERE n.n <= 3 OR (i < n.n - 3 AND ahead >= 60) OR (i >= n.n - 3 AND span >= 60)""",
)
def w01(spark, d):
    return W.density_filter(positions(spark, d), 3, 60)


@query("w02_clustered_sites", f"{NUM} SELECT contig, pos FROM n WHERE prev IS NULL OR pos - prev > 20")
def w02(spark, d):
    return W.far_from_previous(positions(spark, d), 20)


@query("w03_least_gap", f"{NUM} SELECT contig, pos FROM n WHERE prev IS NULL OR pos - prev >= 20")
def w03(spark, d):
    return W.least_gap(positions(spark, d), 20)


@query("w04_least_gap_first", f"{NUM} SELECT contig, pos FROM n WHERE pos - coalesce(prev, pos) >= 20")
def w04(spark, d):
    return W.least_gap(positions(spark, d), 20, first=False)


@query(
    "w05_greedy_thin",
    f"""WITH RECURSIVE {NUM[5:]}, thin AS (SELECT contig, pos, i, pos AS last, TRUE AS keep FROM n WHERE i = 0
  UNION ALL SELECT n.contig, n.pos, n.i, CASE WHEN n.pos - t.last >= 100 THEN n.pos ELSE t.last END, n.pos - t.last >= 100 FROM thin t JOIN n ON n.contig = t.contig AND n.i = t.i + 1)
SELECT contig, pos FROM thin WHERE keep""",
)
def w05(spark, d):
    return W.thin(positions(spark, d), 100)


@query("w07_gap_to_next", f"{NUM} SELECT contig, pos, gap FROM n")
def w07(spark, d):
    return W.gaps(positions(spark, d))


@query("a10_spacing_distribution", f"{NUM} SELECT CAST((2 * gap + 20) // 40 * 20 AS BIGINT) AS bin, count(*) AS n FROM n WHERE gap IS NOT NULL GROUP BY ALL")
def a10(spark, d):
    return W.binned_gaps(positions(spark, d), 20)


@query("a11_percentile_cutoff", f"{NUM} SELECT percentile_disc(0.05) WITHIN GROUP (ORDER BY gap) AS cutoff FROM n WHERE gap IS NOT NULL")
def a11(spark, d):
    return W.percentile_cutoff(positions(spark, d))


@query(
    "a12_bimodal_cutoff",
    f"""{NUM}, b AS (SELECT (2 * gap + 20) // 40 * 20 AS bin, count(*) AS n FROM n WHERE gap IS NOT NULL GROUP BY ALL),
m AS (SELECT sum(bin) / 2.0::DOUBLE AS middle FROM (SELECT bin FROM b ORDER BY n DESC, bin LIMIT 2)),
e AS (SELECT b.bin FROM b, range(1, 1000000) r(k), m WHERE k <= b.n AND b.bin < middle)
SELECT round(avg(bin) + 2 * stddev_samp(bin), 6) AS cutoff FROM e""",
)
def a12(spark, d):
    return W.bimodal_cutoff(positions(spark, d), 20)


SPINE = f"{DEP}, ln AS (SELECT contig, max(pos) AS len FROM dep GROUP BY contig), sp AS (SELECT l.contig, l.pos, coalesce(d.depth, 0) AS depth FROM (SELECT contig, unnest(range(1, len + 1)) AS pos FROM ln) l LEFT JOIN dep d USING (contig, pos))"


def dense(spark, d):
    depth = B.depth(spark, d)
    return W.spine(depth, Q.extents(depth))


@query("j06_zero_backfill", f"{SPINE} SELECT contig, pos, depth FROM sp")
def j06(spark, d):
    return dense(spark, d)


FRAMES = f"""{SPINE}, pad AS (SELECT *, FALSE AS pad FROM sp UNION ALL SELECT contig, unnest(range(len + 1, len + 10)), 0, TRUE FROM ln),
fr AS (SELECT contig, pos, pad, regr_slope(depth, pos) OVER w AS slope, regr_r2(depth, pos) OVER w AS r2 FROM pad WINDOW w AS (PARTITION BY contig ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
ivl AS (SELECT contig, pos AS lo, pos + 9 AS hi FROM fr WHERE NOT pad AND abs(slope) >= 0.25001 AND r2 >= 0.60001)"""


@query("w06_cliffs", f"{FRAMES}, {UNION.format(gap=1)} SELECT contig, lo, hi FROM u")
def w06(spark, d):
    return W.cliffs(dense(spark, d), slope=0.25001, r2=0.60001)


@query("w06b_slopes", f"{FRAMES} SELECT contig, pos, round(slope, 6) + 0 AS slope FROM fr WHERE NOT pad")
def w06b(spark, d):
    return W.slopes(dense(spark, d)).select("contig", "pos", (F.round("slope", 6) + 0).alias("slope"))


PCT = "round(100.0::DOUBLE * {a} / nullif({b}, 0), 6)".format


@query(
    "a24_coverage_report",
    f"{SPINE} SELECT contig, count(*) FILTER (depth < 20) AS low, count(*) FILTER (depth >= 20) AS high, count(*) FILTER (depth > 0) AS breadth, round(sum(depth)::DOUBLE / count(*), 6) AS mean, {PCT(a='count(*) FILTER (depth > 0)', b='count(*)')} AS percent FROM sp GROUP BY contig",
)
def a24(spark, d):
    return Q.coverage(dense(spark, d))


@query(
    "a25_mapping_report",
    f"""{READ}, r AS (SELECT sample, count(*) AS total, count(*) FILTER (mapped) AS mapped, count(*) FILTER (mapped AND mapq >= 30) AS good, count(*) FILTER (mapped AND mapq < 30) AS poor, count(*) FILTER (NOT mapped) AS unmapped FROM rds GROUP BY sample)
SELECT *, {', '.join(f"{PCT(a=c, b='total')} AS {c}_percent" for c in ('mapped', 'good', 'poor', 'unmapped'))} FROM r""",
)
def a25(spark, d):
    return Q.mapping_report(B.reads(spark, d))


@query("a26_short_inserts", f"{READ}, x AS (SELECT sample || '-' || CAST(pos % 50 AS VARCHAR) AS sample, insert_len, read_len FROM rds WHERE mapq < 20) SELECT sample, median(insert_len) AS insert, max(read_len) AS read FROM x GROUP BY sample HAVING 2 * median(insert_len) < max(read_len)")
def a26(spark, d):
    rows = B.reads(spark, d).filter("mapq < 20").withColumn("sample", F.concat_ws("-", "sample", (F.col("pos") % 50).cast("string")))
    return Q.short_inserts(rows)


@query("a27_composition", f"{SEQ} SELECT sample, length(seq) AS length, length(seq) - length(replace(seq, 'n', '')) AS n_count, {PCT(a="(length(seq) - length(replace(seq, 'n', '')))", b='length(seq)')} AS n_percent, {PCT(a="(length(seq) - length(replace(replace(seq, 'g', ''), 'c', '')))", b='length(seq)')} AS gc_percent FROM sq")
def a27(spark, d):
    return Q.composition(B.sequences(spark, d))


@query("a02_ambiguity_percent", f"{ALN}, x AS (SELECT sample, {PCT(a="count(*) FILTER (nt NOT IN ('A', 'C', 'G', 'T'))", b='count(*)')} AS percent FROM col GROUP BY sample) SELECT sample, percent, percent > 2 AS warn FROM x")
def a02(spark, d):
    return Q.ambiguity_percent(B.columns(spark, d), tolerance=2)


@query("a03_masked_percent", f"{GENO} SELECT sample, floor(count(*) FILTER (nt = 'N') * 10000::DOUBLE / count(*)) / 100 AS percent FROM geno GROUP BY sample HAVING floor(count(*) FILTER (nt = 'N') * 10000::DOUBLE / count(*)) / 100 > 10")
def a03(spark, d):
    return Q.masked_percent(B.genotypes(spark, d))


@query("a04_masking_summary", f"{GENO}, s AS (SELECT count(*) FILTER (nt = 'N') AS m, count(*) AS n FROM geno GROUP BY contig, pos) SELECT count(*) AS sites, {PCT(a='count(*) FILTER (m > 0)', b='count(*)')} AS \"any\", {PCT(a='count(*) FILTER (m >= ceil(n / 2.0))', b='count(*)')} AS half, {PCT(a='count(*) FILTER (m = n)', b='count(*)')} AS \"all\" FROM s")
def a04(spark, d):
    return Q.masking_summary(B.genotypes(spark, d))


@query("a04b_masking_summary_alignment", f"{ALN}, s AS (SELECT count(*) FILTER (nt = 'N') AS m, count(*) AS n FROM col GROUP BY pos) SELECT count(*) AS sites, {PCT(a='count(*) FILTER (m > 0)', b='count(*)')} AS \"any\", {PCT(a='count(*) FILTER (m >= ceil(n / 2.0))', b='count(*)')} AS half, {PCT(a='count(*) FILTER (m = n)', b='count(*)')} AS \"all\" FROM s")
def a04b(spark, d):
    return Q.masking_summary(B.columns(spark, d), ("pos",))


@query(
    "a05_reference_representation",
    f"""WITH {B.OBS}, c AS (SELECT 'c' || (p_partkey % 4) AS contig, sum(p_size) AS len FROM part GROUP BY ALL), s AS (SELECT contig, count(*) AS sites FROM (SELECT DISTINCT contig, pos FROM obs) GROUP BY contig)
SELECT t.least, CAST(sum(coalesce(sites, 0)) AS BIGINT) AS sites, CAST(sum(len) AS BIGINT) AS bases, {PCT(a='sum(coalesce(sites, 0))', b='sum(len)')} AS percent FROM c LEFT JOIN s USING (contig), (VALUES (150), (250), (1000)) t(least) WHERE len >= t.least GROUP BY t.least""",
)
def a05(spark, d):
    contigs = table(spark, d, "part").groupBy(F.concat(F.lit("c"), F.col("p_partkey") % 4).alias("contig")).agg(F.sum("p_size").alias("len"))
    return Q.representation(positions(spark, d), contigs)


CODES = ["PASS", "DP3", "AF0.75", "RF0.75", "isIndel"]


@query(
    "a06_code_histogram",
    f"{CALLS}, e AS (SELECT sample, unnest(string_split(ft, ';')) AS code FROM call), x AS (SELECT * FROM e UNION ALL SELECT 'pooled', code FROM e) SELECT sample, {', '.join(f"coalesce(nullif(CAST(count(*) FILTER (code = '{c}') AS VARCHAR), '0'), '.') AS {c.replace('.', '_')}" for c in CODES)} FROM x GROUP BY sample",
)
def a06(spark, d):
    return Q.code_histogram(B.calls(spark, d), CODES)


@query("a29_n_ranking", f"{ALN} SELECT sample, count(*) FILTER (nt = 'N') AS n FROM col GROUP BY sample ORDER BY n DESC, sample")
def a29(spark, d):
    return B.columns(spark, d).groupBy("sample").agg(F.count_if(F.col("nt") == "N").alias("n")).orderBy(F.desc("n"), "sample")


@query("o04_natural_order", "SELECT DISTINCT p_brand AS name, regexp_extract(lower(p_brand), '^(\\D*)', 1) || lpad(regexp_extract(p_brand, '(\\d+)$', 1), 20, '0') AS key FROM part ORDER BY key")
def o04(spark, d):
    rows = table(spark, d, "part").select(F.col("p_brand").alias("name")).distinct()
    return rows.withColumn("key", Q.natural_key(F.col("name"))).orderBy("key")


@query("o05_feature_order", f"{IVL} SELECT contig, lo, hi FROM ivl ORDER BY contig, lo, hi DESC")
def o05(spark, d):
    return B.intervals(spark, d).orderBy("contig", "lo", F.desc("hi"))


@query("o07_sample_order", f"{ALN} SELECT sample, CAST(sample AS VARCHAR) AS name FROM aln ORDER BY name")
def o07(spark, d):
    return B.alignment(spark, d).select("sample", F.col("sample").cast("string").alias("name")).orderBy("name")


@query(
    "j09_mate_pairing",
    """WITH n AS (SELECT CAST(conv_id AS VARCHAR) || '_R' || (turn % 2 + 1) || '_' || turn AS name, CAST(conv_id AS VARCHAR) AS base, turn % 2 + 1 AS k FROM conversations)
SELECT base, min(name) FILTER (k = 1) AS first, min(name) FILTER (k = 2) AS second, count(*) FILTER (k = 1) AS n_first, count(*) FILTER (k = 2) AS n_second FROM n GROUP BY base""",
)
def j09(spark, d):
    rows = table(spark, d, "conversations")
    name = F.concat(F.col("conv_id").cast("string"), F.lit("_R"), (F.col("turn") % 2 + 1).cast("string"), F.lit("_"), F.col("turn").cast("string"))
    return Q.mates(rows.select(name.alias("name")))


@query(
    "j10_checksum_reconciliation",
    """SELECT CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id % 10 = 3 THEN 'missing' WHEN doc_id % 10 = 4 THEN 'changed' ELSE 'ok' END AS state FROM documents WHERE text IS NOT NULL""",
)
def j10(spark, d):
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", F.col("doc_id").cast("string").alias("name"), "text")
    expected = docs.select("name", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"))
    changed = F.when(F.col("doc_id") % 10 == 4, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    present = docs.filter("doc_id % 10 <> 3").select("name", F.encode(changed, "UTF-8").alias("content"))
    return Q.reconcile(expected, present)
