"""Queries over calls, sites and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe import bindings as B
from locusframe import calls as C
from locusframe import sites as S
from locusframe import sources as IO
from locusframe import stripes as P
from locusframe.registry import query, table

CALLS, GENO, ALN, IVL = (f"WITH {x}" for x in (B.CALLS, B.GENO, B.ALN, B.IVL))


@query("a01_pileup_consensus", f"{CALLS} SELECT contig, pos, sample, ref, alt, dp, ad, rd FROM con")
def a01(spark, d):
    return C.consensus(B.observations(spark, d)).select("contig", "pos", "sample", "ref", "alt", "dp", "ad", "rd")


@query("f03_allele_frequency", f"{CALLS} SELECT contig, pos, sample, af, rf FROM fre")
def f03(spark, d):
    return C.frequencies(C.consensus(B.observations(spark, d))).select("contig", "pos", "sample", "af", "rf")


@query(
    "f01_call_quality",
    f"""{CALLS}, {B.IVL}, msk AS (SELECT DISTINCT contig, pos FROM call c WHERE EXISTS (SELECT 1 FROM ivl i WHERE i.contig = c.contig AND c.pos BETWEEN i.lo AND i.hi)),
x AS (SELECT c.*, m.pos IS NOT NULL AS masked FROM call c LEFT JOIN msk m USING (contig, pos))
SELECT contig, pos, sample, CASE WHEN masked THEN CASE WHEN ft = 'PASS' THEN 'masked' ELSE ft || ';masked' END ELSE ft END AS ft,
  CASE WHEN masked THEN './.' ELSE gt END AS gt FROM x""",
)
def f01(spark, d):
    from locusframe.intervals import flagged

    rows = C.frequencies(C.consensus(B.observations(spark, d)))
    rows = flagged(rows, B.intervals(spark, d))
    return C.classify(rows, B.MIN_DEPTH, B.MIN_FRACTION, masked=F.col("masked")).select("contig", "pos", "sample", "ft", "gt")


@query(
    "f02_profile_thresholds",
    f"""{CALLS}, prof AS (SELECT * FROM (VALUES (0, 3, 0.75), (1, 4, 0.9), (2, 2, 0.6)) p(cohort, min_coverage, min_alt_frac))
SELECT contig, pos, sample, CASE WHEN dp < min_coverage OR (CASE WHEN alt <> '.' THEN af ELSE rf END) < min_alt_frac THEN 'FAIL' ELSE 'PASS' END AS verdict
FROM fre JOIN prof ON CAST(substr(sample, 2) AS INTEGER) % 3 = cohort""",
)
def f02(spark, d):
    # a handful of fixed rows
    profiles = spark.createDataFrame([(0, 3, 0.75), (1, 4, 0.9), (2, 2, 0.6)], "cohort int, min_coverage int, min_alt_frac double")
    rows = C.frequencies(C.consensus(B.observations(spark, d))).withColumn("cohort", F.substring("sample", 2, 9).cast("int") % 3)
    rows = C.classify(rows.join(F.broadcast(profiles), "cohort"), F.col("min_coverage"), F.col("min_alt_frac"))
    return rows.select("contig", "pos", "sample", F.when(F.col("ft") == "PASS", "PASS").otherwise("FAIL").alias("verdict"))


@query("f04_genotype_haploid", f"{CALLS} SELECT contig, pos, sample, CASE gt WHEN '0/0' THEN ref WHEN '1/1' THEN alt ELSE 'N' END AS nt FROM call")
def f04(spark, d):
    text = F.when(F.col("gt") == "0/0", F.concat_ws("/", "ref", "ref")).when(F.col("gt") == "1/1", F.concat_ws("|", "alt", "alt")).otherwise("./.")
    return B.calls(spark, d).select("contig", "pos", "sample", C.haploid_of(text).alias("nt"))


@query(
    "f05_ambiguity_code",
    f"""WITH {B.OBS}, l AS (SELECT contig, pos, sample, string_agg(DISTINCT base, '' ORDER BY base) AS k FROM obs GROUP BY ALL)
SELECT contig, pos, sample, CASE k WHEN 'AG' THEN 'R' WHEN 'CT' THEN 'Y' WHEN 'CG' THEN 'S' WHEN 'AT' THEN 'W' WHEN 'GT' THEN 'K' WHEN 'AC' THEN 'M'
  WHEN 'CGT' THEN 'B' WHEN 'AGT' THEN 'D' WHEN 'ACT' THEN 'H' WHEN 'ACG' THEN 'V' WHEN 'ACGT' THEN 'N' ELSE k END AS code FROM l""",
)
def f05(spark, d):
    return B.observations(spark, d).groupBy("contig", "pos", "sample").agg(C.ambiguity(F.collect_set("base")).alias("code"))


PART = """pt AS (SELECT 'c' || (p_partkey % 4) AS contig, p_partkey * 7919 % 100003 + 1 AS pos, substr(p_name, 1, 4) AS ref, substr(p_type, 1, 4) AS alt, p_size AS depth FROM part)"""


def part_sites(spark, d):
    return table(spark, d, "part").select(F.concat(F.lit("c"), F.col("p_partkey") % 4).alias("contig"), (F.col("p_partkey") * 7919 % 100003 + 1).alias("pos"), F.substring("p_name", 1, 4).alias("ref"), F.substring("p_type", 1, 4).alias("alt"), F.col("p_size").alias("depth"))


@query(
    "f06_multibase_explode",
    f"""WITH {PART} SELECT contig, pos + i - 1 AS pos, substr(ref, CAST(i AS INTEGER), 1) AS ref, substr(alt, CAST(i AS INTEGER), 1) AS alt
FROM pt, range(1, 5) r(i) WHERE length(ref) = length(alt) AND depth >= 20 AND i <= length(ref) AND substr(ref, CAST(i AS INTEGER), 1) <> substr(alt, CAST(i AS INTEGER), 1)""",
)
def f06(spark, d):
    return C.split_multibase(part_sites(spark, d), 20)[0]


@query("k04_bad_sites", f"WITH {PART} SELECT DISTINCT contig, pos FROM pt WHERE length(ref) <> length(alt) OR depth < 20")
def k04(spark, d):
    return C.split_multibase(part_sites(spark, d), 20)[1]


@query(
    "f07_snp_only",
    f"WITH {B.OBS} SELECT contig, pos, ref FROM obs GROUP BY ALL HAVING count(*) FILTER (base <> ref) > 0",
)
def f07(spark, d):
    alleles = B.observations(spark, d).groupBy("contig", "pos", "ref").agg(F.collect_set("base").alias("alleles"))
    return S.snps_only(alleles).select("contig", "pos", "ref")


FLAGS = """flg AS (SELECT contig, pos, ref, count(*) AS n, count(*) FILTER (nt = 'N') AS missing, count(DISTINCT nt) AS variants,
  count(DISTINCT CASE WHEN nt = 'N' THEN ref ELSE nt END) AS variants_ref FROM geno GROUP BY ALL)"""
OUTSIDE = "NOT EXISTS (SELECT 1 FROM ivl i WHERE i.contig = x.contig AND x.pos BETWEEN i.lo AND i.hi)"


@query(
    "f08_site_filter",
    f"""WITH RECURSIVE {B.GENO}, {B.IVL}, {FLAGS},
ok AS (SELECT contig, pos FROM flg x WHERE missing < n AND missing = 0 AND variants > 1 AND pos >= 50 AND {OUTSIDE}),
num AS (SELECT contig, pos, row_number() OVER (PARTITION BY contig ORDER BY pos) AS k FROM ok),
thin AS (SELECT contig, pos, k, pos AS last, TRUE AS keep FROM num WHERE k = 1
  UNION ALL SELECT n.contig, n.pos, n.k, CASE WHEN n.pos - t.last >= 50 THEN n.pos ELSE t.last END, n.pos - t.last >= 50
  FROM thin t JOIN num n ON n.contig = t.contig AND n.k = t.k + 1)
SELECT g.contig, g.pos, g.sample, g.nt FROM geno g JOIN thin t ON g.contig = t.contig AND g.pos = t.pos WHERE t.keep""",
)
def f08(spark, d):
    return S.site_filter(B.genotypes(spark, d), mask=B.intervals(spark, d), flanking=50).select("contig", "pos", "sample", "nt")


@query(
    "f08b_site_filter_ns_as_ref",
    f"{GENO}, {FLAGS} SELECT g.contig, g.pos, g.sample, g.nt FROM geno g JOIN flg USING (contig, pos) WHERE missing < n AND variants_ref > 1",
)
def f08b(spark, d):
    return S.site_filter(B.genotypes(spark, d), ambiguities=True, ns_as_ref=True).select("contig", "pos", "sample", "nt")


@query(
    "f09_informative_columns",
    f"""{ALN}, c AS (SELECT pos, nt, count(*) AS c FROM col GROUP BY ALL),
g AS (SELECT pos FROM c GROUP BY pos HAVING count(*) FILTER (nt <> 'N') > 1 AND min(c) FILTER (nt <> 'N') / sum(c) >= 0.05)
SELECT sample, pos, nt FROM col JOIN g USING (pos)""",
)
def f09(spark, d):
    return S.informative_columns(B.columns(spark, d), ambiguities=True, least_minority=0.05)


@query(
    "f10_informative_sites",
    f"{GENO}, x AS (SELECT contig, pos FROM geno GROUP BY ALL HAVING count(DISTINCT nt) > 1 AND count(*) FILTER (nt = 'N') = 0) SELECT contig, pos, sample, nt FROM geno JOIN x USING (contig, pos)",
)
def f10(spark, d):
    return S.informative_sites(B.genotypes(spark, d)).select("contig", "pos", "sample", "nt")


@query(
    "f11_strict_columns",
    f"{ALN}, x AS (SELECT pos, label FROM col GROUP BY ALL HAVING count(*) FILTER (nt = 'N') = 0 AND min(nt) <> max(nt)) SELECT sample, label, pos, nt FROM col JOIN x USING (pos, label)",
)
def f11(spark, d):
    labels = table(spark, d, "embeddings").select(F.col("vec_id").alias("sample"), "label")
    # each label's samples are an alignment of their own
    rows = B.columns(spark, d).join(labels, "sample").withColumn("pos", F.struct("label", "pos"))
    return S.strict_columns(rows).select("sample", "label", F.col("pos.pos").alias("pos"), "nt")


@query(
    "f12_filter_correction",
    f"""{CALLS} SELECT contig, pos, sample, ft AS old_ft, CASE WHEN ft <> 'PASS' AND dp >= 4 AND 100 * af < 5 THEN 'PASS' ELSE ft END AS new_ft FROM call""",
)
def f12(spark, d):
    return C.corrected(B.calls(spark, d), least_depth=4)


@query("f13_two_sample_difference", f"{GENO} SELECT a.contig, a.pos, a.nt AS nt_a, b.nt AS nt_b FROM geno a JOIN geno b USING (contig, pos) WHERE a.sample = 's1' AND b.sample = 's2' AND a.nt <> b.nt AND a.nt <> 'N' AND b.nt <> 'N'")
def f13(spark, d):
    return S.differences(B.genotypes(spark, d), "s1", "s2")


@query(
    "f14_name_normalisation",
    r"""WITH f AS (SELECT page_id, regexp_extract(url, '([^/]+)$', 1) || '.sorted.vcf.gz' AS file FROM pages)
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(file, '\.(gz|bz2)$', ''), '\.(vcf|bam|sam|fastq|fq|fasta|fa|html?|txt)$', ''), '\.(sorted|cleaned|unique|shuffled|trimmed)$', ''), '-reference$', '') AS name FROM f""",
)
def f14(spark, d):
    file = F.concat(F.regexp_extract("url", "([^/]+)$", 1), F.lit(".sorted.vcf.gz"))
    return table(spark, d, "pages").select("page_id", IO.sample_name(file).alias("name"))


@query("f14b_rename_collisions", "WITH r AS (SELECT source, regexp_replace(source, '[0-9]$', '') AS name FROM (SELECT DISTINCT source FROM documents)), c AS (SELECT name, count(*) > 1 AS collides FROM r GROUP BY name) SELECT doc_id, name, collides FROM documents d JOIN r ON d.source = r.source JOIN c USING (name)")
def f14b(spark, d):
    rows = IO.rename(table(spark, d, "documents").select("doc_id", "source"), "source", "[0-9]$", "")
    return rows.select("doc_id", F.col("source").alias("name"), "collides")


@query("f15_id_guards", "SELECT p_name AS id, count(*) AS n, contains(p_name, ' ') AS reserved FROM part GROUP BY ALL HAVING count(*) > 1 OR contains(p_name, ' ')")
def f15(spark, d):
    from locusframe.qc import bad_ids

    return bad_ids(table(spark, d, "part").select(F.col("p_name").alias("id")), reserved=" ")


@query("s01_call_ingest", f"{CALLS} SELECT contig, pos, sample, ref, alt, ft FROM call")
def s01(spark, d):
    path = IO.scratch(spark, "calls")
    IO.call_lines(B.calls(spark, d)).write.partitionBy("sample").option("compression", "gzip").text(path)
    return IO.read_calls(spark, path).select("contig", "pos", "sample", "ref", "alt", "ft")


@query("s02_info_unpack", f"{CALLS} SELECT contig, pos, sample, dp, adp, ad, rd, gt FROM call")
def s02(spark, d):
    path = IO.scratch(spark, "calls")
    IO.call_lines(B.calls(spark, d)).write.partitionBy("sample").text(path)
    rows = IO.unpack(IO.read_calls(spark, path))
    number = lambda m, k: F.element_at(m, k).cast("int").alias(k.lower())
    return rows.select("contig", "pos", "sample", number("info", "DP"), number("info", "ADP"), number("fields", "AD"), number("fields", "RD"), F.element_at("fields", "GT").alias("gt"))


@query("s03_alignment_scan", f"{ALN} SELECT sample, pos, nt FROM col")
def s03(spark, d):
    return B.columns(spark, d)


@query("s03b_alignment_flush", f"{ALN} SELECT min(length(seq)) AS least, max(length(seq)) AS most, min(length(seq)) = max(length(seq)) AS flush FROM aln")
def s03b(spark, d):
    return IO.flush(B.alignment(spark, d))


@query("s04_interval_scan", f"{IVL} SELECT contig, lo, hi FROM ivl")
def s04(spark, d):
    path = IO.scratch(spark, "intervals")
    B.intervals(spark, d).select("contig", "hi", "lo").write.csv(path, sep="\t")
    return IO.read_intervals(spark, path)


@query("s05_site_matrix_scan", f"{GENO} SELECT contig, pos, ref, sample, nt FROM geno")
def s05(spark, d):
    path = IO.scratch(spark, "matrix")
    IO.write_matrix(IO.wide(B.genotypes(spark, d), B.SAMPLES), path)
    return IO.read_matrix(spark, path)


@query("s06_transposed_scan", f"{GENO} SELECT contig, pos, sample, nt FROM geno")
def s06(spark, d):
    path = IO.scratch(spark, "transposed")
    IO.write_transposed(IO.transposed_lines(B.genotypes(spark, d)), path)
    return IO.transposed_to_long(IO.read_transposed(spark, path))


@query("k01_matrix_sink", f"{GENO} SELECT contig, pos, ref, {', '.join(f"coalesce(max(nt) FILTER (sample = '{s}'), 'N') AS {s}" for s in B.SAMPLES)} FROM geno GROUP BY ALL")
def k01(spark, d):
    path = IO.scratch(spark, "matrix")
    IO.wide(B.genotypes(spark, d), B.SAMPLES).write.csv(path, sep="\t", header=True)
    return spark.read.csv(path, sep="\t", header=True, schema="contig string, pos long, ref string, " + ", ".join(f"{s} string" for s in B.SAMPLES))


@query("k02_alignment_sink", f"{GENO} SELECT sample, string_agg(nt, '' ORDER BY contig, pos) AS seq FROM geno GROUP BY sample")
def k02(spark, d):
    path = IO.scratch(spark, "alignment")
    IO.write_fasta(IO.alignment(B.genotypes(spark, d)), path)
    return IO.read_fasta(spark, path)


@query(
    "k03_transposed_sink",
    f"""{GENO} SELECT sample, string_agg(nt, chr(9) ORDER BY contig, pos) AS line FROM geno GROUP BY sample
UNION ALL SELECT '.', string_agg(contig || ':' || pos, chr(9) ORDER BY contig, pos) FROM site""",
)
def k03(spark, d):
    path = IO.scratch(spark, "transposed")
    IO.write_transposed(IO.transposed_lines(B.genotypes(spark, d)), path)
    return IO.read_transposed(spark, path)


@query("j01_cohort_merge", f"{GENO} SELECT contig, pos, ref, sample, nt FROM geno")
def j01(spark, d):
    return B.genotypes(spark, d)


@query("j05_consensus_backfill", f"{GENO} SELECT s.contig, s.pos, m.sample, CASE WHEN c.alt <> '.' THEN c.alt WHEN c.dp >= 3 THEN s.ref ELSE 'N' END AS nt FROM site s CROSS JOIN (SELECT DISTINCT sample FROM hap) m LEFT JOIN call c ON c.contig = s.contig AND c.pos = s.pos AND c.sample = m.sample")
def j05(spark, d):
    rows = B.calls(spark, d)
    return C.backfilled(rows.select("contig", "pos", "ref").distinct(), rows.select("sample"), rows, 3).select("contig", "pos", "sample", "nt")


@query(
    "j07_seed_sites",
    f"{GENO}, s AS (SELECT contig, pos FROM geno WHERE sample = 's0' AND nt <> ref AND nt <> 'N') SELECT contig, pos, sample, nt FROM geno JOIN s USING (contig, pos)",
)
def j07(spark, d):
    return S.seeded(B.genotypes(spark, d), "s0").select("contig", "pos", "sample", "nt")


@query("u01_concat_dedup", f"WITH {B.OBS} SELECT DISTINCT contig, pos, sample FROM obs")
def u01(spark, d):
    rows = B.observations(spark, d).select("contig", "pos", "sample")
    return rows.filter("pos <= 60000").unionByName(rows.filter("pos >= 40000")).dropDuplicates(["contig", "pos", "sample"])


@query(
    "u02_private_sites",
    f"""{GENO}, v AS (SELECT contig, pos, bool_or(sample < 's4') AS a, bool_or(sample >= 's4') AS b FROM geno WHERE nt <> ref AND nt <> 'N' GROUP BY ALL)
SELECT contig, pos, CASE WHEN a AND b THEN 'both' WHEN a THEN 'a' ELSE 'b' END AS part FROM v""",
)
def u02(spark, d):
    return S.private_sites(B.genotypes(spark, d).filter("nt <> ref and nt <> 'N'"), F.col("sample") < "s4")


@query("u05_bad_site_union", f"WITH {PART}, {B.IVL} SELECT contig, pos FROM pt WHERE depth < 20 UNION SELECT contig, lo FROM ivl")
def u05(spark, d):
    low = part_sites(spark, d).filter("depth < 20").select("contig", "pos")
    return low.union(B.intervals(spark, d).select("contig", "lo")).distinct()


@query("a23_constant_sites", f"{GENO}, x AS (SELECT min(nt) AS nt FROM geno GROUP BY contig, pos HAVING min(nt) = max(nt) AND min(nt) <> 'N') SELECT nt, count(*) AS sites FROM x GROUP BY nt")
def a23(spark, d):
    return S.composition(B.genotypes(spark, d))


@query("a28_site_counts", f"{GENO}, {FLAGS} SELECT count(*) AS sites, count(*) FILTER (missing = 0 AND variants > 1) AS kept, round(100.0::DOUBLE * count(*) FILTER (missing = 0 AND variants > 1) / count(*), 6) AS percent FROM flg")
def a28(spark, d):
    good = (F.col("missing") == 0) & (F.col("variants") > 1)
    out = S.site_flags(B.genotypes(spark, d)).agg(F.count(F.lit(1)).alias("sites"), F.count_if(good).alias("kept"))
    return out.withColumn("percent", F.round(100.0 * F.col("kept") / F.col("sites"), 6))


@query("o02_coordinate_sort", f"{CALLS} SELECT contig, pos, sample FROM call ORDER BY ALL")
def o02(spark, d):
    return B.calls(spark, d).select("contig", "pos", "sample").orderBy("contig", "pos", "sample")


STRIPED = f"{GENO}, nb AS (SELECT contig, pos, row_number() OVER (ORDER BY contig, pos) - 1 AS i FROM site)"


@query("k02b_striped_alignment_sink", f"{STRIPED} SELECT sample, i // 100 * 100 AS \"offset\", string_agg(nt, '' ORDER BY i) AS seq FROM geno JOIN nb USING (contig, pos) GROUP BY ALL")
def k02b(spark, d):
    path = IO.scratch(spark, "stripes")
    P.write_stripes(P.stripes(B.genotypes(spark, d), 100), path)
    return P.read_stripes(spark, path)


@query(
    "k03b_striped_transposed_sink",
    f"""{STRIPED} SELECT sample, i // 50 * 50 AS "offset", string_agg(nt, chr(9) ORDER BY i) AS seq FROM geno JOIN nb USING (contig, pos) GROUP BY ALL
UNION ALL SELECT '.', i // 50 * 50, string_agg(contig || ':' || pos, chr(9) ORDER BY i) FROM nb GROUP BY ALL""",
)
def k03b(spark, d):
    path = IO.scratch(spark, "transposed-stripes")
    P.write_stripes(P.transposed_stripes(B.genotypes(spark, d), 50), path)
    return P.read_stripes(spark, path)


@query("r04b_striped_transpose", f"{STRIPED} SELECT sample, i AS number, nt FROM geno JOIN nb USING (contig, pos)")
def r04b(spark, d):
    return P.opened(P.stripes(IO.matrix_to_long(IO.wide(B.genotypes(spark, d), B.SAMPLES)), 64))


@query("o03_sorted_positions", f"WITH {B.OBS} SELECT DISTINCT contig, pos FROM obs ORDER BY ALL")
def o03(spark, d):
    return B.observations(spark, d).select("contig", "pos").distinct().orderBy("contig", "pos")


@query("r04_transpose", f"{GENO} SELECT sample, count(*) AS sites, string_agg(nt, '' ORDER BY contig, pos) AS seq FROM geno GROUP BY sample")
def r04(spark, d):
    long = IO.matrix_to_long(IO.wide(B.genotypes(spark, d), B.SAMPLES))
    return IO.alignment(long).select("sample", F.char_length("seq").cast("long").alias("sites"), "seq")


@query("r05_alignment_concat", f"{ALN} SELECT sample, CASE WHEN sample % 3 = 0 THEN repeat('-', 32) ELSE substr(seq, 1, 32) END || 'NN' || substr(seq, 33, 32) AS seq FROM aln")
def r05(spark, d):
    from locusframe.distance import concatenated

    rows = B.alignment(spark, d)
    first = rows.filter("sample % 3 <> 0").select(F.lit(0).alias("block"), "sample", F.substring("seq", 1, 32).alias("seq"))
    return concatenated(first.unionByName(rows.select(F.lit(1).alias("block"), "sample", F.substring("seq", 33, 32).alias("seq"))), linker="NN")


@query(
    "r05b_striped_concat",
    f"""{ALN}, j AS (SELECT sample, CASE WHEN sample % 3 = 0 THEN repeat('-', 32) ELSE substr(seq, 1, 32) END || 'NN' || substr(seq, 33, 32) AS seq FROM aln)
SELECT sample, CAST(i AS BIGINT) AS number, seq[CAST(i + 1 AS INTEGER)] AS nt FROM (SELECT sample, seq, unnest(range(66)) AS i FROM j)""",
)
def r05b(spark, d):
    rows = B.alignment(spark, d)
    first = rows.filter("sample % 3 <> 0").select(F.lit(0).alias("block"), "sample", F.substring("seq", 1, 32).alias("seq"))
    blocks = first.unionByName(rows.select(F.lit(1).alias("block"), "sample", F.substring("seq", 33, 32).alias("seq")))
    return P.opened(P.concatenated(P.cut(blocks, 10), "NN", 7))
