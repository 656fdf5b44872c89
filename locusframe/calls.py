"""Calls: consensus from observations, frequencies, quality codes, genotypes, cohort merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["contig", "pos", "sample"]


def consensus(observations: DataFrame) -> DataFrame:
    """A call for each (contig, pos, sample): alt is the most frequent base, `.` if it is the reference (which wins ties)."""
    counts = observations.groupBy(*KEY, "ref", "base").agg(F.count(F.lit(1)).alias("n"))
    # the order of the best: count, then the reference, then the smaller letter
    rank = F.struct(F.col("n"), (F.col("base") == F.col("ref")).alias("own"), (-F.ascii("base")).alias("letter"))
    best = counts.groupBy(*KEY, "ref").agg(F.max_by(F.struct("base", "n"), rank).alias("best"), F.sum("n").alias("dp"), F.sum(F.when(F.col("base") == F.col("ref"), F.col("n")).otherwise(0)).alias("rd"))
    same = F.col("best.base") == F.col("ref")
    return best.select(*KEY, "ref", F.when(same, ".").otherwise(F.col("best.base")).alias("alt"), F.col("dp").cast("int").alias("dp"), F.col("dp").cast("int").alias("adp"), F.when(same, 0).otherwise(F.col("best.n")).cast("int").alias("ad"), F.col("rd").cast("int").alias("rd"))


def _fraction(part: Column, whole: Column) -> Column:
    """part / whole to two places, half up, in whole numbers; 0 of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.floor((200 * part + whole) / (2 * whole).cast("double")) / 100)


def frequencies(calls: DataFrame) -> DataFrame:
    """af and rf: alternate and reference share of adp, rounded before any threshold."""
    return calls.withColumn("af", _fraction(F.col("ad"), F.col("adp"))).withColumn("rf", _fraction(F.col("rd"), F.col("adp")))


def classify(calls: DataFrame, coverage: int | Column = 10, fraction: float | Column = 0.75, masked: Column | None = None, swap_labels: bool = False) -> DataFrame:
    """ft: `PASS` or failure codes; gt: `0/0`, `1/1`, or `./.` after a failure. Thresholds may be columns."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    coverage, fraction = lit(coverage), lit(fraction)
    low_alt, low_ref = (("RF", "AF") if swap_labels else ("AF", "RF"))
    snp = F.col("alt") != "."
    indel = (F.char_length("ref") != F.char_length("alt")) & snp
    code = lambda name, x: F.concat(F.lit(name), x.cast("string"))
    codes = [
        F.when(F.col("dp") < coverage, code("DP", coverage)),
        F.when(snp & (F.col("af") < fraction), code(low_alt, fraction)),
        F.when(~snp & (F.col("rf") < fraction), code(low_ref, fraction)),
        F.when(indel, F.lit("isIndel")),
        F.when(masked, F.lit("masked")) if masked is not None else F.lit(None).cast("string"),
    ]
    failed = F.array_compact(F.array(*codes))
    out = calls.withColumn("ft", F.when(F.size(failed) == 0, "PASS").otherwise(F.array_join(failed, ";")))
    return out.withColumn("gt", F.when(F.col("ft") != "PASS", "./.").when(snp, "1/1").otherwise("0/0"))


def haploid_of(gt: Column) -> Column:
    """`x/x` or `x|x` of one letter to x; anything else to N."""
    part = F.split(gt, "[/|]")
    one = F.element_at(part, 1)
    return F.when((F.array_min(part) == F.array_max(part)) & (F.char_length(one) == 1) & one.rlike("^[A-Za-z*-]$"), one).otherwise("N")


def haploid(calls: DataFrame) -> DataFrame:
    """contig, pos, ref, sample, nt: the letter that gt stands for, N if none."""
    return calls.select("contig", "pos", "ref", "sample", F.when(F.col("gt") == "0/0", F.col("ref")).when(F.col("gt") == "1/1", F.col("alt")).otherwise("N").alias("nt"))


#: Ambiguity codes of nucleotide pairs and sets (IUPAC); fixed values.
AMBIGUITY = {"AG": "R", "CT": "Y", "CG": "S", "AT": "W", "GT": "K", "AC": "M", "CGT": "B", "AGT": "D", "ACT": "H", "ACG": "V", "ACGT": "N"}


def ambiguity(letters: Column) -> Column:
    """The ambiguity code of an array of nucleotides; a single one is itself, none N."""
    key = F.array_join(F.array_sort(F.array_distinct(F.transform(letters, F.upper))), "")
    codes = F.create_map(*[F.lit(x) for kv in AMBIGUITY.items() for x in kv])
    return F.when(key.isin("A", "C", "G", "T"), key).otherwise(F.coalesce(F.try_element_at(codes, key), F.lit("N")))


def cohort(genotypes: DataFrame, missing: str = "N") -> DataFrame:
    """Every site of the union for every sample, `missing` where a sample has no call; repeated calls count once.

    The sample list goes along as one array, so each site is opened in place and nothing is crossed.
    """
    one = genotypes.groupBy("contig", "pos", "ref", "sample").agg(F.min("nt").alias("nt"))
    sites = one.groupBy("contig", "pos", "ref").agg(F.map_from_entries(F.collect_list(F.struct("sample", "nt"))).alias("held"))
    samples = genotypes.agg(F.collect_set("sample").alias("samples"))
    rows = sites.crossJoin(F.broadcast(samples)).select("contig", "pos", "ref", "held", F.explode("samples").alias("sample"))
    return rows.select("contig", "pos", "ref", "sample", F.coalesce(F.try_element_at("held", F.col("sample")), F.lit(missing)).alias("nt"))


def split_multibase(sites: DataFrame, least_depth: int) -> tuple[DataFrame, DataFrame]:
    """(one row for each differing base of substitutions of enough depth; sites that are indels or too shallow).

    sites: contig, pos, ref, alt, depth. The shorter allele is padded with `*`; equal bases go.
    """
    bad = (F.char_length("ref") != F.char_length("alt")) | (F.col("depth") < least_depth)
    n = F.greatest(F.char_length("ref"), F.char_length("alt"))
    pairs = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct((i - 1).alias("at"), F.substring(F.rpad("ref", n, "*"), i, F.lit(1)).alias("r"), F.substring(F.rpad("alt", n, "*"), i, F.lit(1)).alias("a")))
    good = sites.filter(~bad).select("contig", "pos", F.explode(pairs).alias("p")).filter("p.r <> p.a")
    return good.select("contig", (F.col("pos") + F.col("p.at")).alias("pos"), F.col("p.r").alias("ref"), F.col("p.a").alias("alt")), sites.filter(bad).select("contig", "pos").distinct()


def corrected(calls: DataFrame, least_depth: int = 20, most_percent: float = 5.0) -> DataFrame:
    """contig, pos, sample, old_ft, new_ft: calls that failed though deep and almost without alternates pass."""
    promoted = (F.col("ft") != "PASS") & (F.col("dp") >= least_depth) & (100 * F.col("af") < most_percent)
    return calls.select("contig", "pos", "sample", F.col("ft").alias("old_ft"), F.when(promoted, "PASS").otherwise(F.col("ft")).alias("new_ft"))


def backfilled(sites: DataFrame, samples: DataFrame, calls: DataFrame, coverage: int) -> DataFrame:
    """For each site and sample: its alternate base; else the reference base if deep enough; else N.

    sites: contig, pos, ref. calls: contig, pos, sample, alt (`.`: none), dp.
    """
    named = samples.agg(F.collect_set("sample").alias("samples"))
    every = sites.crossJoin(F.broadcast(named)).select("contig", "pos", "ref", F.explode("samples").alias("sample"))
    found = every.join(calls.select(*KEY, "alt", "dp"), KEY, "left")
    nt = F.when(F.col("alt") != ".", F.col("alt")).when(F.col("dp") >= coverage, F.col("ref")).otherwise("N")
    return found.select("contig", "pos", "ref", "sample", nt.alias("nt"))
