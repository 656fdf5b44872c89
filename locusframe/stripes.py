"""Alignments as ordered pieces, so that no value holds a genome.

Sites are numbered over the whole table; a sample's letters of `width` neighbouring sites are one row, with the number of its
first site. Pieces are written in order and read in any: each carries its sample and offset. Every sample has a row at every
site (see calls.cohort), else its pieces are short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusframe.along import ranked, with_keys
from locusframe.sources import kept

#: Sites of a piece.
WIDTH = 1 << 16


def numbered(genotypes: DataFrame) -> DataFrame:
    """genotypes with _i: the site's number from 0, in order of contig and pos."""
    sites = ranked(genotypes.select("contig", "pos").distinct(), "contig", "pos")
    return with_keys(genotypes, sites, ("contig", "pos"))


def _pieces(cells: DataFrame, value: str, between: str, width: int) -> DataFrame:
    rows = cells.groupBy("sample", F.floor(F.col("_i") / width).alias("stripe")).agg(F.array_sort(F.collect_list(F.struct("_i", value))).alias("c"))
    return rows.select("sample", (F.col("stripe") * width).alias("offset"), F.array_join(F.transform("c", lambda x: x[value]), between).alias("seq"))


def stripes(genotypes: DataFrame, width: int = WIDTH) -> DataFrame:
    """sample, offset, seq: at most `width` sites' letters a row."""
    return _pieces(numbered(genotypes), "nt", "", width)


def transposed_stripes(genotypes: DataFrame, width: int = WIDTH) -> DataFrame:
    """sample, offset, seq: letters with tabs between, and under the sample `.` the sites' names (contig:pos)."""
    cells = numbered(genotypes)
    head = cells.select(F.lit(".").alias("sample"), "_i", F.concat_ws(":", "contig", F.col("pos").cast("string")).alias("nt")).distinct()
    return _pieces(cells.select("sample", "_i", "nt").unionByName(head), "nt", "\t", width)


def opened(pieces: DataFrame, letters: Column | None = None) -> DataFrame:
    """sample, number (of the site, from 0), nt of stripes; letters: how a piece is cut (characters, if not given)."""
    cut = F.regexp_extract_all("seq", F.lit("(?s)."), F.lit(0)) if letters is None else letters
    rows = pieces.filter("seq <> ''").select("sample", "offset", F.posexplode(cut).alias("at", "nt"))
    return rows.select("sample", (F.col("offset") + F.col("at")).alias("number"), "nt")


def cut(alignment: DataFrame, width: int = WIDTH) -> DataFrame:
    """alignment (sample, seq and others) in pieces: offset and seq of at most `width` letters."""
    rest = [c for c in alignment.columns if c != "seq"]
    parts = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    return alignment.filter("seq <> ''").select(*rest, F.posexplode(parts).alias("at", "seq")).select(*rest, (F.col("at") * width).cast("long").alias("offset"), "seq")


def concatenated(pieces: DataFrame, linker: str = "", width: int = WIDTH) -> DataFrame:
    """sample, offset, seq: the blocks (block, sample, offset, seq) of each sample in order, gaps for those it is not in.

    Where a block begins is carried in a table with one row a block; pieces move by that and are not joined to longer ones.
    """
    lengths = pieces.groupBy("block").agg(F.max(F.col("offset") + F.char_length("seq")).alias("n"))
    # over one row a block
    order = Window.orderBy("block")
    before = F.coalesce(F.sum(F.col("n") + len(linker)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    layout = kept(lengths.select("block", "n", before.alias("start"), (F.row_number().over(order) - 1).alias("number")), "layout")
    blocks = layout.count()
    moved = pieces.join(layout, "block").select("sample", (F.col("offset") + F.col("start")).alias("offset"), "seq")
    if blocks == 0:
        return moved
    held = pieces.join(layout, "block").select("sample", "number").distinct()
    every = pieces.select("sample").distinct().select("sample", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("number"))
    missing = every.join(held, ["sample", "number"], "left_anti").join(layout, "number")
    missing = missing.select("sample", "start", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(width).cast("long"))).alias("at"))
    gaps = missing.select("sample", (F.col("start") + F.col("at")).alias("offset"), F.repeat(F.lit("-"), F.least(F.lit(width), F.col("n") - F.col("at")).cast("int")).alias("seq"))
    out = moved.unionByName(gaps)
    if linker:
        links = every.filter(F.col("number") < blocks - 1).join(layout, "number")
        out = out.unionByName(links.select("sample", (F.col("start") + F.col("n")).alias("offset"), F.lit(linker).alias("seq")))
    return out


def write_stripes(pieces: DataFrame, path: str) -> None:
    """Text files, in order of sample and offset: `>sample offset`, then the piece."""
    ordered = pieces.orderBy("sample", "offset")
    ordered.select(F.concat(F.lit(">"), F.col("sample").cast("string"), F.lit(" "), F.col("offset").cast("string"), F.lit("\n"), "seq")).write.text(path)


def read_stripes(spark: SparkSession, path: str) -> DataFrame:
    """sample, offset, seq of write_stripes."""
    rows = spark.read.option("lineSep", ">").text(path).filter("value <> ''")
    head = F.substring_index("value", "\n", 1)
    seq = F.regexp_replace(F.regexp_replace("value", "^[^\n]*\n?", ""), "[\r\n]", "")
    return rows.select(F.regexp_extract(head, "^(.*) [0-9]+$", 1).alias("sample"), F.regexp_extract(head, " ([0-9]+)$", 1).cast("long").alias("offset"), seq.alias("seq"))
