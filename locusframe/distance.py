"""Pairwise distances between samples, their matrices and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe import pairs
from locusframe.along import with_keys
from locusframe.sources import kept

VALID = ("A", "C", "G", "T")


#: Samples of one block meet in one row or task.
BLOCK = 64


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("sample"), F.lit(blocks)).cast("int")


def _all_pairs(samples: DataFrame, blocks: int) -> DataFrame:
    """a, na, b, nb (a < b) of every pair of samples (sample, n). Samples meet under keys of block pairs."""
    rows = samples.withColumn("block", _block(blocks))
    left = rows.select("sample", "n", F.col("block").alias("x"), F.explode(F.sequence("block", F.lit(blocks - 1))).alias("y"))
    right = rows.select(F.col("sample").alias("s2"), F.col("n").alias("n2"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("x"), F.col("block").alias("y"))
    both = left.join(right, ["x", "y"]).filter("x < y or sample < s2")
    first = F.col("sample") < F.col("s2")
    pick = lambda x, y, name: F.when(first, F.col(x)).otherwise(F.col(y)).alias(name)
    return both.select(pick("sample", "s2", "a"), pick("n", "n2", "na"), pick("s2", "sample", "b"), pick("n2", "n", "nb"))


def deltas(genotypes: DataFrame, site: tuple[str, ...], total: int, blocks: int) -> DataFrame:
    """site, block, direct, act, pas: what samples of a block have at a site besides its majority letter.

    act: (sample, nt) of nucleotides that are not the majority's (of equal ones the first of A, C, G, T). Where few are
    missing, pas has the samples without a nucleotide; where more are missing than have the majority's, or a sample has no row,
    the site is `direct` and pas has the samples with the majority's. Sites without variation go.
    """
    nt = F.upper("nt")
    cells = genotypes.select(*site, "sample", F.coalesce(F.when(nt.isin(*VALID), nt), F.lit("?")).alias("nt"), _block(blocks).alias("block"))
    counts = [F.count_if(F.col("nt") == x).alias(f"n_{x}") for x in VALID] + [F.count(F.lit(1)).alias("n_all")]
    rows = cells.groupBy(*site, "block").agg(F.array_sort(F.collect_list(F.struct("sample", "nt"))).alias("c"), *counts)
    if blocks > 1:
        names = [f"n_{x}" for x in (*VALID, "all")]
        rows = with_keys(rows.drop(*names), rows.groupBy(*site).agg(*[F.sum(c).alias(c) for c in names]), site)
    top = F.greatest(*[f"n_{x}" for x in VALID])
    valid = sum((F.col(f"n_{x}") for x in VALID[1:]), F.col(f"n_{VALID[0]}"))
    major = F.coalesce(*[F.when(F.col(f"n_{x}") == top, F.lit(x)) for x in VALID])
    direct = (F.col("n_all") < total) | (F.col("n_all") - valid > top)
    rows = rows.filter(valid > top).withColumn("direct", direct).withColumn("major", major).withColumn("rest", F.when(F.col("direct"), F.col("major")).otherwise("?"))
    act = F.filter("c", lambda x: (x["nt"] != "?") & (x["nt"] != F.col("major")))
    pas = F.transform(F.filter("c", lambda x: x["nt"] == F.col("rest")), lambda x: x["sample"])
    return rows.select(*site, "block", "direct", act.alias("act"), pas.alias("pas")).filter("size(act) > 0 or size(pas) > 0")


def pairwise(genotypes: DataFrame, site: tuple[str, ...] = ("contig", "pos"), block: int = BLOCK) -> DataFrame:
    """a, b, d of every pair of samples: sites where both have a nucleotide and they differ. For many sites; a sample has one row
    a site at most.

    Samples are sets of deviations from each site's majority letter. Were every deviation a difference, d would be the sum of
    two set sizes; what is too much is taken off by pairs: 2 where both deviate alike, 1 where they deviate otherwise or one
    deviates and the other is missing. So a site costs the square of its deviations (times those missing), not all its pairs.
    At direct sites differences are counted as such. A row has one block's samples; equal rows are counted before pairs are made.
    """
    names = genotypes.select("sample").distinct()
    total = names.count()
    blocks = max(1, -(-total // block))
    rows = kept(deltas(genotypes, site, total, blocks), "deltas")
    sizes = rows.filter("not direct").select(F.explode("act").alias("x")).groupBy(F.col("x.sample").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    sized = names.join(sizes, F.col("sample") == F.col("of"), "left").select("sample", F.coalesce("n", F.lit(0)).alias("n"))

    def met(lists: DataFrame) -> DataFrame:
        # direct, act, xs (act of the same or a later block), pas: counted, then opened
        lists = lists.filter("size(act) > 0 and (size(xs) > 0 or size(pas) > 0)").groupBy("direct", "act", "xs", "pas", "own").agg(F.count(F.lit(1)).alias("n"))
        lists = lists.select("direct", "xs", "pas", "own", "n", F.explode("act").alias("one"))
        direct, one = F.col("direct"), F.col("one")
        less = lambda x: F.when(direct, F.when(x["nt"] == one["nt"], 0).otherwise(-1)).otherwise(F.when(x["nt"] == one["nt"], 2).otherwise(1))
        later = F.filter("xs", lambda x: ~F.col("own") | (x["sample"] > one["sample"]))
        others = F.concat(F.transform(later, lambda x: F.struct(x["sample"].alias("q"), less(x).alias("less"))), F.transform("pas", lambda x: F.struct(x.alias("q"), F.when(direct, -1).otherwise(1).alias("less"))))
        found = lists.select(one["sample"].alias("p"), "n", F.explode(others).alias("o")).filter("o.less <> 0")
        return found.select(F.least("p", "o.q").alias("a"), F.greatest("p", "o.q").alias("b"), (F.col("n") * F.col("o.less")).alias("less"))

    less = met(rows.select("direct", "act", F.col("act").alias("xs"), "pas", F.lit(True).alias("own")))
    if blocks > 1:
        others = rows.select(*site, F.col("block").alias("other"), F.col("act").alias("xs"), "pas")
        across = with_keys(rows.select(*site, "block", "direct", "act").filter("size(act) > 0"), others, site, "inner").filter("block <> other")
        later = F.when(F.col("block") < F.col("other"), F.col("xs")).otherwise(F.filter("xs", lambda x: F.lit(False)))
        less = less.unionByName(met(across.select("direct", "act", later.alias("xs"), "pas", F.lit(False).alias("own"))))
    less = less.groupBy("a", "b").agg(F.sum("less").alias("less"))
    return _all_pairs(sized, blocks).join(less, ["a", "b"], "left").select("a", "b", (F.col("na") + F.col("nb") - F.coalesce("less", F.lit(0))).cast("long").alias("d"))


def pairwise_packed(alignment: DataFrame, blocks: int | None = None) -> DataFrame:
    """a, b, d by population counts over bit planes (see `pairs`). For many samples; the result has a row a pair."""
    return pairs.every(alignment, blocks=blocks)


def estimated(genotypes: DataFrame, percent: int = 25, site: tuple[str, ...] = ("contig", "pos")) -> DataFrame:
    """a, b, d from about `percent` of the positions (those whose number hashes low), scaled up."""
    some = genotypes.filter(F.pmod(F.col("pos") * 7919, F.lit(100)) < percent)
    return pairwise(some, site).withColumn("d", F.floor(F.col("d") * 100 / percent).cast("long"))


def histogram(edges: DataFrame, size: int = 100) -> DataFrame:
    """bin, n of the distances."""
    return edges.groupBy((F.floor(F.col("d") / size) * size).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("bin")


def square(edges: DataFrame, names: list, zero_as_dash: bool = False) -> DataFrame:
    """sample and a column for each of names: the distance as text, `-` where there is none."""
    both = edges.select("a", "b", "d").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    text = F.when(F.lit(zero_as_dash) & (F.col("d") == 0), "-").otherwise(F.col("d").cast("string"))
    out = both.select(F.col("a").alias("sample"), F.col("b").cast("string").alias("b"), text.alias("t")).groupBy("sample").pivot("b", [str(x) for x in names]).agg(F.first("t"))
    return out.na.fill("-")


def unsquare(matrix: DataFrame) -> DataFrame:
    """a, b, d of a square matrix: each pair once, the diagonal kept, `-` as 0."""
    long = matrix.unpivot(["sample"], [c for c in matrix.columns if c != "sample"], "other", "t")
    d = F.when(F.col("t") == "-", 0).otherwise(F.col("t").cast("long"))
    return long.groupBy(F.least("sample", "other").alias("a"), F.greatest("sample", "other").alias("b")).agg(F.max(d).cast("long").alias("d"))


def phylip(edges: DataFrame) -> DataFrame:
    """sample, row: distances to all samples in order, 0 to itself, `?` for a missing pair; complete: nothing is missing."""
    both = edges.select("a", "b", "d").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    names = both.agg(F.array_sort(F.collect_set("a")).alias("names"))
    rows = both.groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("b", "d"))).alias("m")).crossJoin(F.broadcast(names))
    cell = F.transform("names", lambda n: F.when(n == F.col("a"), "0").otherwise(F.coalesce(F.try_element_at("m", n).cast("string"), F.lit("?"))))
    return rows.select(F.col("a").alias("sample"), F.array_join(cell, " ").alias("row"), (F.size("m") == F.size("names") - 1).alias("complete"))


def concatenated(blocks: DataFrame, linker: str = "") -> DataFrame:
    """sample, seq: the blocks (block, sample, seq) of each sample in order, gaps for those it is not in."""
    lengths = blocks.groupBy("block").agg(F.max(F.char_length("seq")).alias("n"))
    layout = lengths.agg(F.array_sort(F.collect_list(F.struct("block", "n"))).alias("layout"))
    rows = blocks.groupBy("sample").agg(F.map_from_entries(F.collect_list(F.struct("block", "seq"))).alias("m")).crossJoin(F.broadcast(layout))
    part = F.transform("layout", lambda x: F.coalesce(F.try_element_at("m", x["block"]), F.repeat(F.lit("-"), x["n"])))
    return rows.select("sample", F.array_join(part, linker).alias("seq"))


def extremes(edges: DataFrame) -> DataFrame:
    """The nearest and the farthest pair: which, a, b, d; ties by name."""
    key = F.struct("a", "b")
    low = edges.agg(F.min_by(F.struct("a", "b", "d"), F.struct("d", key)).alias("e")).select(F.lit("nearest").alias("which"), "e.*")
    high = edges.agg(F.min_by(F.struct("a", "b", "d"), F.struct((-F.col("d")).alias("d"), key)).alias("e")).select(F.lit("farthest").alias("which"), "e.*")
    return low.unionByName(high).filter("a is not null")


def most_distant(edges: DataFrame, d: str = "d") -> DataFrame:
    """sample, total: the one with the largest sum of distances; ties to the smaller name."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("sample"), F.col(d).alias("d")).groupBy("sample").agg(F.sum("d").alias("total"))
    return ends.orderBy(F.desc("total"), "sample").limit(1)
