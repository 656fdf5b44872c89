"""Quality reports over alignments, matrices, reads and sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _percent(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 6)


def bad_ids(rows: DataFrame, reserved: str = ":") -> DataFrame:
    """id, n, reserved: ids that occur more than once or hold a reserved character."""
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).withColumn("reserved", F.contains("id", F.lit(reserved))).filter("n > 1 or reserved")


def ambiguity_percent(columns: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """sample, percent of letters that are no nucleotide, warn."""
    out = columns.groupBy("sample").agg(_percent(F.count_if(~F.upper("nt").rlike("^[ACGT]$")), F.count(F.lit(1))).alias("percent"))
    return out.withColumn("warn", F.col("percent") > tolerance)


def masked_percent(genotypes: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """sample, percent of sites that are N, cut to two places; those above the tolerance."""
    share = F.floor(F.count_if(F.col("nt") == "N") * 10000 / F.count(F.lit(1))) / 100
    return genotypes.groupBy("sample").agg(share.alias("percent")).filter(F.col("percent") > tolerance)


def masking_summary(genotypes: DataFrame, site: tuple[str, ...] = ("contig", "pos")) -> DataFrame:
    """sites, and percent of them masked in any, at least half, all samples."""
    per = genotypes.groupBy(*site).agg(F.count_if(F.col("nt") == "N").alias("m"), F.count(F.lit(1)).alias("n"))
    every = F.count(F.lit(1))
    return per.agg(every.alias("sites"), _percent(F.count_if(F.col("m") > 0), every).alias("any"), _percent(F.count_if(F.col("m") >= F.ceil(F.col("n") / 2)), every).alias("half"), _percent(F.count_if(F.col("m") == F.col("n")), every).alias("all"))


def representation(sites: DataFrame, contigs: DataFrame, least: tuple[int, ...] = (150, 250, 1000)) -> DataFrame:
    """least, sites, bases, percent: sites in contigs (contig, len) of at least so many bases, of those contigs' bases."""
    n = sites.groupBy("contig").agg(F.count(F.lit(1)).alias("sites"))
    rows = contigs.join(n, "contig", "left").select("len", F.coalesce("sites", F.lit(0)).alias("sites"), F.explode(F.array(*[F.lit(x) for x in least])).alias("least"))
    out = rows.filter("len >= least").groupBy("least").agg(F.sum("sites").alias("sites"), F.sum("len").alias("bases"))
    return out.withColumn("percent", _percent(F.col("sites"), F.col("bases")))


def code_histogram(calls: DataFrame, codes: list[str]) -> DataFrame:
    """sample (`pooled` for all) and a column for each code (dots in its name as _): how many calls have it, `.` if none."""
    rows = calls.select("sample", F.explode(F.split("ft", ";")).alias("code"))
    rows = rows.unionByName(rows.withColumn("sample", F.lit("pooled")))
    out = rows.groupBy("sample").pivot("code", codes).count()
    return out.select("sample", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(".")).alias(c.replace(".", "_")) for c in codes])


def extents(rows: DataFrame, position: str = "pos") -> DataFrame:
    """contig, len: the largest position of each contig."""
    return rows.groupBy("contig").agg(F.max(position).cast("long").alias("len"))


def coverage(dense: DataFrame, least: int = 20) -> DataFrame:
    """contig, low, high (positions below and from `least` on), breadth (positions with any), mean, percent with any."""
    n = F.count(F.lit(1))
    return dense.groupBy("contig").agg(F.count_if(F.col("depth") < least).alias("low"), F.count_if(F.col("depth") >= least).alias("high"), F.count_if(F.col("depth") > 0).alias("breadth"), F.round(F.sum("depth") / n, 6).alias("mean"), _percent(F.count_if(F.col("depth") > 0), n).alias("percent"))


def mapping_report(reads: DataFrame, quality: int = 30) -> DataFrame:
    """sample, total, mapped, good, poor (mapped, by mapping quality), unmapped, and percentages of the total."""
    m = F.col("mapped")
    out = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("total"), F.count_if(m).alias("mapped"), F.count_if(m & (F.col("mapq") >= quality)).alias("good"), F.count_if(m & (F.col("mapq") < quality)).alias("poor"), F.count_if(~m).alias("unmapped"))
    return out.select("*", *[_percent(F.col(c), F.col("total")).alias(f"{c}_percent") for c in ("mapped", "good", "poor", "unmapped")])


def short_inserts(reads: DataFrame) -> DataFrame:
    """sample, insert (median), read (longest): samples whose reads overlap, 2 * insert < read."""
    out = reads.groupBy("sample").agg(F.median("insert_len").alias("insert"), F.max("read_len").alias("read"))
    return out.filter(2 * F.col("insert") < F.col("read"))


def composition(sequences: DataFrame, gc: str = "gc") -> DataFrame:
    """sample, length, n_count, n_percent, gc_percent; letters in any case; gc over the full length."""
    n = F.char_length("seq")
    count = lambda letters: n - F.char_length(F.translate(F.lower("seq"), letters, ""))
    return sequences.select("sample", n.cast("long").alias("length"), count("n").cast("long").alias("n_count"), _percent(count("n"), n).alias("n_percent"), _percent(count(gc), n).alias("gc_percent"))


def mapped_reads(reads: DataFrame, least_quality: int = 4) -> DataFrame:
    """Mapped reads of enough quality."""
    return reads.filter(F.col("mapped") & (F.col("mapq") >= least_quality))


def natural_key(name: Column) -> Column:
    """A sort key under which runs of digits compare as numbers (of up to 20 digits), letters without case."""
    parts = F.regexp_extract_all(name, F.lit("\\d+|\\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^\\d"), F.lpad(x, 20, "0")).otherwise(F.lower(x))), "")


def mates(names: DataFrame, pattern: str = "^(.*?)(?:_R?|\\.)([12])(?:[_.].*)?$") -> DataFrame:
    """base, first, second, n_first, n_second: names paired by what stands before the read number."""
    rows = names.select("name", F.regexp_extract("name", pattern, 1).alias("base"), F.regexp_extract("name", pattern, 2).alias("k")).filter("k <> ''")
    pick = lambda k: F.min(F.when(F.col("k") == k, F.col("name")))
    return rows.groupBy("base").agg(pick("1").alias("first"), pick("2").alias("second"), F.count_if(F.col("k") == "1").alias("n_first"), F.count_if(F.col("k") == "2").alias("n_second"))


def reconcile(expected: DataFrame, present: DataFrame) -> DataFrame:
    """name, state: `ok`, `changed` or `missing` of expected (name, digest) against present (name, content)."""
    have = present.select("name", F.sha2(F.col("content"), 256).alias("found"))
    state = F.when(F.col("found").isNull(), "missing").when(F.col("found") == F.col("digest"), "ok").otherwise("changed")
    return expected.join(have, "name", "left").select("name", state.alias("state"))
