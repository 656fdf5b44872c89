"""The tables at hand in the roles that the operators take (see FIXTURES.md), and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe import calls as C
from locusframe.registry import table

SAMPLES = [f"s{i}" for i in range(8)]
MIN_DEPTH, MIN_FRACTION = 3, 0.75


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    letter = lambda e: F.expr(f"substring('ACGT', cast(1 + ({e}) % 4 as int), 1)")
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_discount")
    sample = F.col("l_suppkey") % 8
    base = F.when(F.col("l_discount") >= 0.09, letter("l_partkey + l_linenumber")).when((F.col("l_partkey") * 31 + sample * 17) % 11 == 0, letter("l_partkey + 1")).otherwise(letter("l_partkey"))
    return rows.select(F.concat(F.lit("c"), F.col("l_partkey") % 4).alias("contig"), (F.col("l_partkey") * 7919 % 100003 + 1).alias("pos"), F.concat(F.lit("s"), sample).alias("sample"), letter("l_partkey").alias("ref"), base.alias("base"))


OBS = """obs AS (
  SELECT 'c' || (l_partkey % 4) AS contig, l_partkey * 7919 % 100003 + 1 AS pos, 's' || (l_suppkey % 8) AS sample,
    substr('ACGT', CAST(1 + l_partkey % 4 AS INTEGER), 1) AS ref,
    CASE WHEN l_discount >= 0.09 THEN substr('ACGT', CAST(1 + (l_partkey + l_linenumber) % 4 AS INTEGER), 1)
         WHEN (l_partkey * 31 + (l_suppkey % 8) * 17) % 11 = 0 THEN substr('ACGT', CAST(1 + (l_partkey + 1) % 4 AS INTEGER), 1)
         ELSE substr('ACGT', CAST(1 + l_partkey % 4 AS INTEGER), 1) END AS base
  FROM lineitem)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classify(C.frequencies(C.consensus(observations(spark, sf_dir))), MIN_DEPTH, MIN_FRACTION)


CALLS = (
    OBS
    + """,
cnt AS (SELECT contig, pos, sample, ref, base, count(*) AS n FROM obs GROUP BY ALL),
best AS (
  SELECT *, sum(n) OVER w AS dp, coalesce(sum(CASE WHEN base = ref THEN n END) OVER w, 0) AS rd,
    row_number() OVER (PARTITION BY contig, pos, sample ORDER BY n DESC, base <> ref, base) AS k
  FROM cnt WINDOW w AS (PARTITION BY contig, pos, sample)),
con AS (
  SELECT contig, pos, sample, ref, CASE WHEN base = ref THEN '.' ELSE base END AS alt, CAST(dp AS INTEGER) AS dp, CAST(dp AS INTEGER) AS adp,
    CAST(CASE WHEN base = ref THEN 0 ELSE n END AS INTEGER) AS ad, CAST(rd AS INTEGER) AS rd
  FROM best WHERE k = 1),
fre AS (
  SELECT *, CASE WHEN adp = 0 THEN 0.0::DOUBLE ELSE floor((200 * ad + adp) / (2.0::DOUBLE * adp)) / 100 END AS af,
    CASE WHEN adp = 0 THEN 0.0::DOUBLE ELSE floor((200 * rd + adp) / (2.0::DOUBLE * adp)) / 100 END AS rf
  FROM con),
call AS (
  SELECT *, CASE WHEN ft = 'PASS' THEN CASE WHEN alt = '.' THEN '0/0' ELSE '1/1' END ELSE './.' END AS gt
  FROM (SELECT *, coalesce(nullif(concat_ws(';', CASE WHEN dp < 3 THEN 'DP3' END, CASE WHEN alt <> '.' AND af < 0.75 THEN 'AF0.75' END,
    CASE WHEN alt = '.' AND rf < 0.75 THEN 'RF0.75' END), ''), 'PASS') AS ft FROM fre))"""
)


def genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.cohort(C.haploid(calls(spark, sf_dir)))


GENO = (
    CALLS
    + """,
hap AS (SELECT contig, pos, ref, sample, CASE gt WHEN '0/0' THEN ref WHEN '1/1' THEN alt ELSE 'N' END AS nt FROM call),
site AS (SELECT DISTINCT contig, pos, ref FROM hap),
geno AS (
  SELECT s.contig, s.pos, s.ref, m.sample, coalesce(h.nt, 'N') AS nt
  FROM site s CROSS JOIN (SELECT DISTINCT sample FROM hap) m
  LEFT JOIN hap h ON h.contig = s.contig AND h.pos = s.pos AND h.sample = m.sample)"""
)


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample (a number), seq: 64 letters."""
    letter = lambda x: F.when(F.abs(x) < 0.005, "N").when(x < -0.1, "A").when(x < 0, "C").when(x < 0.1, "G").otherwise("T")
    values = F.transform("embedding", lambda x: letter(x.cast("double")))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample"), F.array_join(values, "").alias("seq"))


ALN = """aln AS (
  SELECT vec_id AS sample, label, array_to_string(list_transform(embedding, lambda x: CASE WHEN abs(x::DOUBLE) < 0.005 THEN 'N'
    WHEN x::DOUBLE < -0.1 THEN 'A' WHEN x::DOUBLE < 0 THEN 'C' WHEN x::DOUBLE < 0.1 THEN 'G' ELSE 'T' END), '') AS seq
  FROM embeddings),
col AS (SELECT sample, label, i AS pos, substr(seq, CAST(i AS INTEGER), 1) AS nt FROM aln, range(1, 65) r(i))"""


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.sources import alignment_to_long

    return alignment_to_long(alignment(spark, sf_dir))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = F.col("p_partkey") * 7919 % 100003 + 1
    return table(spark, sf_dir, "part").filter("p_brand = 'Brand#13'").select(F.concat(F.lit("c"), F.col("p_partkey") % 4).alias("contig"), lo.alias("lo"), (lo + F.col("p_size") * 20).alias("hi"))


IVL = """ivl AS (
  SELECT 'c' || (p_partkey % 4) AS contig, p_partkey * 7919 % 100003 + 1 AS lo, p_partkey * 7919 % 100003 + 1 + p_size * 20 AS hi
  FROM part WHERE p_brand = 'Brand#13')"""


def depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """contig, pos (hours from 1), depth; sparse."""
    hour = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(F.to_timestamp(F.lit("2024-01-01 00:00:00")))) / 3600)
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("contig"), (hour + 1).alias("pos")).agg(F.count(F.lit(1)).cast("int").alias("depth"))


DEP = """dep AS (
  SELECT event_type AS contig, CAST(floor((epoch(ts) - epoch(TIMESTAMP '2024-01-01 00:00:00')) / 3600) AS BIGINT) + 1 AS pos, CAST(count(*) AS INTEGER) AS depth
  FROM events GROUP BY ALL)"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey") % 8).alias("sample"),
        F.concat(F.lit("c"), F.col("l_partkey") % 4).alias("contig"),
        (F.col("l_partkey") * 7919 % 100003 + 1).alias("pos"),
        (F.col("l_returnflag") != "R").alias("mapped"),
        q.alias("mapq"),
        (q * 10).alias("insert_len"),
        (100 + F.col("l_linenumber") * 25).alias("read_len"),
    )


READ = """rds AS (
  SELECT 's' || (l_suppkey % 8) AS sample, 'c' || (l_partkey % 4) AS contig, l_partkey * 7919 % 100003 + 1 AS pos, l_returnflag <> 'R' AS mapped,
    CAST(l_quantity AS INTEGER) AS mapq, CAST(l_quantity AS INTEGER) * 10 AS insert_len, 100 + l_linenumber * 25 AS read_len
  FROM lineitem)"""


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample (a number), seq: lower-case text."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample"), F.lower(F.coalesce("text", F.lit(""))).alias("seq"))


SEQ = """sq AS (SELECT doc_id AS sample, lower(coalesce(text, '')) AS seq FROM documents)"""
