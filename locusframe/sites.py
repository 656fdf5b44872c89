"""Site filters over genotypes (contig, pos, ref, sample, nt), and column filters over alignments (sample, pos, nt)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe import intervals as I
from locusframe import spacing
from locusframe.sources import kept

SITE = ["contig", "pos", "ref"]


def _keep(rows: DataFrame, sites: DataFrame, by: list[str]) -> DataFrame:
    return rows.join(sites.select(*by), by, "left_semi")


def site_flags(genotypes: DataFrame, ns_as_ref: bool = False) -> DataFrame:
    """Per site: n, missing, ambiguous (letters other than A, C, G, T), variants (different alleles)."""
    nt = F.upper("nt")
    allele = F.when((nt == "N") & F.lit(ns_as_ref), F.upper("ref")).otherwise(nt)
    return genotypes.groupBy(*SITE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(nt == "N").alias("missing"),
        F.count_if(~nt.isin("A", "C", "G", "T")).alias("ambiguous"),
        F.count_distinct(allele).alias("variants"),
    )


def site_filter(genotypes: DataFrame, mask: DataFrame | None = None, ambiguities: bool = False, invariant: bool = False, ns_as_ref: bool = False, flanking: int = 0) -> DataFrame:
    """The main filter. Sites in the mask, all-missing ones, those with ambiguity (unless `ambiguities`), and those without
    variation (unless `invariant`) go; of the rest, sites closer than `flanking` to the last one kept.

    Genotypes are flagged and then taken, and thinning reads its sites several times: both are written once."""
    genotypes = kept(genotypes, "genotypes")
    good = site_flags(genotypes, ns_as_ref).filter("missing < n")
    if not ambiguities:
        good = good.filter("ambiguous = 0")
    if not invariant:
        good = good.filter("variants > 1")
    if mask is not None:
        good = I.outside(good, mask)
    if flanking:
        good = spacing.thin(kept(good.filter(F.col("pos") >= flanking), "good-sites"), flanking)
    return _keep(genotypes, good, SITE)


def informative_columns(columns: DataFrame, ambiguities: bool = False, gaps: bool = False, least_minority: float = 0.0) -> DataFrame:
    """Alignment columns with variation, which N never counts as. Columns with N or gaps go unless allowed; so do those in
    which an allele is rarer than least_minority."""
    nt = F.upper("nt")
    counts = columns.withColumn("nt", nt).groupBy("pos", "nt").agg(F.count(F.lit(1)).alias("c"))
    real = F.col("nt") != "N"
    flags = counts.groupBy("pos").agg(F.count_if(real).alias("alleles"), F.max(F.when(~real, True).otherwise(False)).alias("has_n"), F.max(F.col("nt").isin("-", "*")).alias("has_gap"), (F.min(F.when(real, F.col("c"))) / F.sum("c")).alias("rarest"))
    good = flags.filter("alleles > 1").filter(F.col("rarest") >= least_minority)
    if not ambiguities:
        good = good.filter("not has_n")
    if not gaps:
        good = good.filter("not has_gap")
    return _keep(columns, good, ["pos"])


def informative_sites(genotypes: DataFrame, ambiguities: bool = False, gaps: bool = False) -> DataFrame:
    """Sites with more than one letter, N included. Sites with indels (`*`, `-`, long alleles) or ambiguous letters go unless
    allowed."""
    nt = F.upper("nt")
    indel = nt.isin("*", "-") | (F.char_length("nt") > 1)
    flags = genotypes.groupBy(*SITE).agg(F.max(indel).alias("indel"), F.max(nt.rlike("^\\w$") & ~nt.isin("A", "C", "G", "T")).alias("ambiguous"), F.count_distinct(nt).alias("letters"))
    good = flags.filter("letters > 1")
    if not gaps:
        good = good.filter("not indel")
    if not ambiguities:
        good = good.filter("not ambiguous")
    return _keep(genotypes, good, SITE)


def strict_columns(columns: DataFrame) -> DataFrame:
    """Alignment columns without N, - or * in which not all letters are equal."""
    nt = F.upper("nt")
    good = columns.groupBy("pos").agg(F.max(nt.isin("N", "-", "*")).alias("bad"), F.min(nt).alias("a"), F.max(nt).alias("b")).filter("not bad and a <> b")
    return _keep(columns, good, ["pos"])


def snps_only(sites: DataFrame) -> DataFrame:
    """Sites (ref, alleles: array) with a one-letter reference and another one-letter allele."""
    other = F.exists("alleles", lambda a: (a != F.col("ref")) & (F.char_length(a) == 1))
    return sites.filter((F.char_length("ref") == 1) & other)


def differences(genotypes: DataFrame, a: str, b: str) -> DataFrame:
    """contig, pos, nt_a, nt_b: sites where two samples differ and neither is N."""
    one = genotypes.filter(F.col("sample").isin(a, b)).groupBy("contig", "pos").agg(F.max(F.when(F.col("sample") == a, F.col("nt"))).alias("nt_a"), F.max(F.when(F.col("sample") == b, F.col("nt"))).alias("nt_b"))
    return one.filter("nt_a <> nt_b and nt_a <> 'N' and nt_b <> 'N'")


def seeded(genotypes: DataFrame, sample: str) -> DataFrame:
    """Genotypes at the sites where one sample differs from the reference."""
    seeds = genotypes.filter((F.col("sample") == sample) & (F.col("nt") != F.col("ref")) & (F.col("nt") != "N")).select("contig", "pos").distinct()
    return genotypes.join(seeds, ["contig", "pos"], "left_semi")


def composition(genotypes: DataFrame) -> DataFrame:
    """nt, sites: of the sites where all samples agree."""
    same = genotypes.groupBy("contig", "pos").agg(F.min("nt").alias("nt"), F.max("nt").alias("other")).filter("nt = other and nt <> 'N'")
    return same.groupBy("nt").agg(F.count(F.lit(1)).alias("sites"))


def private_sites(variants: DataFrame, in_a) -> DataFrame:
    """contig, pos, part (`a`, `b`, `both`): where variants (contig, pos, sample) occur, by a condition for group a."""
    flags = variants.groupBy("contig", "pos").agg(F.max(in_a).alias("a"), F.max(~in_a).alias("b"))
    return flags.select("contig", "pos", F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "a").otherwise("b").alias("part"))
