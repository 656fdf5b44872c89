"""Intervals: union, complement, soft merging, tiling, and point-in-interval joins. Bounds are closed and 1-based."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.along import WIDTH, binned, neighbours, with_keys
from locusframe.sources import kept

#: Up to so many coalesced intervals are broadcast; more are joined by bins.
BROADCAST_ROWS = 10_000


def union(intervals: DataFrame, gap: int = 1, bin_size: int = WIDTH) -> DataFrame:
    """contig, lo, hi: intervals that overlap or are at most `gap` apart become one (1: adjacent integers join).

    In bins of starts. How far the intervals of earlier bins reach, and how many islands they begin, is carried over in a
    table with one row a bin.
    """
    keys = ("contig", "_bin")
    rows = binned(intervals.select("contig", "lo", "hi").filter("lo is not null"), "lo", bin_size)
    order, before = Window.partitionBy("contig").orderBy("_bin"), (Window.unboundedPreceding, -1)
    reach = rows.groupBy(*keys).agg(F.max("hi").alias("_hi")).select(*keys, F.max("_hi").over(order.rowsBetween(*before)).alias("_reach"))
    inner = Window.partitionBy(*keys).orderBy("lo", "hi")
    rows = with_keys(rows.withColumn("_held", F.max("hi").over(inner.rowsBetween(*before))), reach, keys)
    rows = rows.withColumn("_new", F.when(F.col("lo") <= F.greatest("_held", "_reach") + gap, 0).otherwise(1)).drop("_held", "_reach")
    islands = rows.groupBy(*keys).agg(F.sum("_new").alias("_n")).select(*keys, F.coalesce(F.sum("_n").over(order.rowsBetween(*before)), F.lit(0)).alias("_begun"))
    rows = rows.withColumn("_in", F.sum("_new").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = with_keys(rows, islands, keys)
    return rows.groupBy("contig", (F.col("_begun") + F.col("_in")).alias("_island")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("contig", "lo", "hi")


def complement(intervals: DataFrame, extents: DataFrame, last_base: bool = True) -> DataFrame:
    """contig, lo, hi: what a contig's intervals leave of 1..len (..len - 1 without last_base); all contigs of extents."""
    end = F.col("len") if last_base else F.col("len") - 1
    merged = neighbours(union(intervals), "lo").select("contig", "lo", "hi", F.col("_next").alias("next"), F.col("_prev").isNull().alias("first"))
    rows = extents.join(merged, "contig", "left")
    head = rows.filter("lo is null or first").select("contig", F.lit(1).cast("long").alias("lo"), F.coalesce(F.least(F.col("lo") - 1, end), end).alias("hi"))
    rest = rows.filter("lo is not null").select("contig", (F.col("hi") + 1).alias("lo"), F.least(F.coalesce(F.col("next") - 1, end), end).alias("hi"))
    return head.unionByName(rest).filter("lo <= hi")


#: Widths of bins grow by this factor from one level to the next, LEVELS of them.
FACTOR, LEVELS = 64, 9


def nested(merged: DataFrame, bin_size: int) -> DataFrame:
    """merged (disjoint intervals with lo, hi) with level and bin: one row or two for each, however long.

    An interval goes to the first level whose bins are no narrower than it. Being disjoint, those of a bin are few: no more than
    FACTOR + 2, as they are wider than the bins of the level below.
    """
    size = F.col("hi") - F.col("lo") + 1
    level = F.coalesce(*[F.when(size <= bin_size * FACTOR**k, F.lit(k)) for k in range(LEVELS - 1)], F.lit(LEVELS - 1))
    width = F.element_at(F.array(*[F.lit(min(bin_size * FACTOR**k, 1 << 62)).cast("long") for k in range(LEVELS)]), level + 1)
    rows = merged.withColumn("level", level).withColumn("width", width)
    return rows.withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / F.col("width")), F.floor(F.col("hi") / F.col("width"))))).drop("width")


def _matched(points: DataFrame, intervals: DataFrame, how: str, bin_size: int, few: bool | None) -> DataFrame:
    """points joined to the merged intervals that hold them. Many intervals meet the points by nested bins: on one level by
    one key a point; on several, different positions have a key a level and then meet the points again."""
    merged = union(intervals).select(F.col("contig").alias("i_contig"), "lo", "hi")
    if few is None:
        few = merged.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    within = F.col("pos").between(F.col("lo"), F.col("hi"))
    if few:
        return points.join(F.broadcast(merged), (F.col("contig") == F.col("i_contig")) & within, how)
    rows = kept(nested(merged, bin_size).withColumnsRenamed({"level": "i_level", "bin": "i_bin"}), "nested-intervals")
    levels = sorted(r.i_level for r in rows.select("i_level").distinct().collect())
    place = lambda k: F.floor(F.col("pos") / min(bin_size * FACTOR**k, 1 << 62))
    if len(levels) < 2:
        out = points.join(rows, (F.col("contig") == F.col("i_contig")) & (place(levels[0] if levels else 0) == F.col("i_bin")) & within, how)
        return out.drop("i_level", "i_bin")
    keyed = points.select("contig", "pos").distinct().withColumn("k", F.explode(F.array(*[F.struct(F.lit(k).alias("level"), place(k).alias("bin")) for k in levels])))
    held = keyed.join(rows, (F.col("contig") == F.col("i_contig")) & (F.col("k.level") == F.col("i_level")) & (F.col("k.bin") == F.col("i_bin")) & within)
    held = held.select("i_contig", F.col("pos").alias("i_pos"), "lo", "hi")
    return points.join(held, (F.col("contig") == F.col("i_contig")) & (F.col("pos") == F.col("i_pos")), how).drop("i_pos")


def outside(points: DataFrame, intervals: DataFrame, bin_size: int = 10_000, few: bool | None = None) -> DataFrame:
    """The rows of points (contig, pos, ...) that no interval holds."""
    return _matched(points, intervals, "left_anti", bin_size, few)


def inside(points: DataFrame, intervals: DataFrame, bin_size: int = 10_000, few: bool | None = None) -> DataFrame:
    """The rows of points (contig, pos, ...) that an interval holds."""
    return _matched(points, intervals, "left_semi", bin_size, few)


def flagged(points: DataFrame, intervals: DataFrame, bin_size: int = 10_000, few: bool | None = None) -> DataFrame:
    """points with `masked`: whether an interval holds them. Merged intervals hold a point once, so no row doubles."""
    return _matched(points, intervals, "left", bin_size, few).withColumn("masked", F.col("lo").isNotNull()).drop("i_contig", "lo", "hi")


def soft_merge(intervals: DataFrame, flank: int = 3000) -> DataFrame:
    """Intervals with at most `flank` positions between them become one; lone ones stay as they are."""
    return union(intervals, gap=flank + 1)


def tiles(extents: DataFrame, size: int, overlap: int = 0) -> DataFrame:
    """contig, lo, hi: chunks of `size`, each reaching `overlap` into the next, up to the contig's length."""
    starts = F.explode(F.sequence(F.lit(1).cast("long"), F.col("len"), F.lit(size).cast("long")))
    rows = extents.filter("len > 0").select("contig", "len", starts.alias("lo"))
    return rows.select("contig", "lo", F.least(F.col("lo") + size - 1 + overlap, F.col("len")).alias("hi"))


def hits(rows: DataFrame, identity: float = 50.0, chance: float = 0.05) -> DataFrame:
    """contig, lo, hi of alignment hits (contig, start, stop, offset, identity, e) good enough, shifted to the contig."""
    good = rows.filter((F.col("identity") >= identity) & (F.col("e") <= chance))
    a, b = F.col("start") + F.col("offset"), F.col("stop") + F.col("offset")
    return good.select("contig", F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
