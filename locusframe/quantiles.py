"""Exact order statistics of groups, without a group's values in one place.

Values are counted, then ranks are narrowed down by histograms: a group's range is cut into equal bins, the bin that holds a
rank is cut again, until its least and largest value are the same. A pass shuffles counts of bins; its ordered sums are over the
bins of one range. A range of w whole numbers takes log(w) / log(BINS) passes; values of many magnitudes take some more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.along import with_keys
from locusframe.sources import discard, kept

BINS = 1024


@dataclass(frozen=True)
class Quantile:
    """A share of a group's values, as the value at a rank (the first that at least this share is not above) or, if
    `between`, by interpolation of the two next to it."""

    name: str
    at: float
    between: bool = False

    def ranks(self, n: Column) -> list[tuple[Column, Column]]:
        """(rank from 1, weight)."""
        if not self.between:
            return [(F.greatest(F.lit(1), F.ceil(n * F.lit(self.at))), F.lit(1.0))]
        place = (n - 1) * F.lit(self.at)
        return [(F.floor(place) + 1, 1 - (place - F.floor(place))), (F.ceil(place) + 1, place - F.floor(place))]


def median(name: str = "median") -> Quantile:
    return Quantile(name, 0.5, between=True)


def _magnitude(x: Column) -> Column:
    """A number that grows with x, and for values of one sign with their logarithm."""
    x = x.cast("double")
    return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * (F.log2(F.abs(x)) + 1100))


def quantiles(rows: DataFrame, value: str, wanted: list[Quantile], by: tuple[str, ...] = (), bins: int = BINS) -> DataFrame:
    """by and a column for each of wanted (of the value's type, double if between) for every group with a value; null values
    count for nothing, null keys are groups. Without `by` the result has one row, null if there is no value."""
    keys = by or ("_all",)
    kind = rows.schema[value].dataType
    plain = rows.filter(F.col(value).isNotNull()).select(*by, *([] if by else [F.lit(0).alias("_all")]), F.col(value).alias("_v"))
    counts = kept(plain.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    per = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    targets = [F.struct(F.lit(q.name).alias("_q"), k.cast("long").alias("_k"), w.cast("double").alias("_w")) for q in wanted for k, w in q.ranks(F.col("_size"))]
    state = kept(per.select(*keys, "_lo", "_hi", F.explode(F.array(*targets)).alias("t")).select(*keys, "_lo", "_hi", "t.*").filter("_w > 0"), "ranks")
    spent = []
    while state.filter("_lo < _hi").limit(1).count():
        ranges = state.filter("_lo < _hi").select(*keys, "_lo", "_hi").distinct()
        named = ranges.withColumnsRenamed({k: f"_key_{k}" for k in keys})
        same = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
        # the ends of a range are bins of their own, so every pass gets on; from the third on, every other cuts by magnitude
        scaled = _magnitude if len(spent) > 1 and len(spent) % 2 == 0 else lambda x: x.cast("double")
        v, lo, hi = (scaled(F.col(c)) for c in ("_v", "_lo", "_hi"))
        share = F.nanvl(F.try_divide(v - lo, hi - lo), F.lit(0.0))
        inner = F.least(F.lit(bins), F.greatest(F.lit(0), F.floor(share * bins)))
        place = F.when(F.col("_v") == F.col("_lo"), -1).when(F.col("_v") == F.col("_hi"), bins + 1).otherwise(F.coalesce(inner, F.lit(0)))
        held = counts.join(named, same).groupBy(*keys, "_lo", "_hi", place.alias("_bin")).agg(F.sum("_n").alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
        upto = F.sum("_n").over(Window.partitionBy(*keys, "_lo", "_hi").orderBy("_bin"))
        held = held.withColumn("_upto", upto).select(*keys, F.col("_lo").alias("_l"), F.col("_hi").alias("_h"), "_from", "_to", "_upto", (F.col("_upto") - F.col("_n")).alias("_less"))
        there = (F.col("_lo") == F.col("_l")) & (F.col("_hi") == F.col("_h")) & (F.col("_k") > F.col("_less")) & (F.col("_k") <= F.col("_upto"))
        for k in keys:
            there = there & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
        found = state.filter("_lo < _hi").join(held.withColumnsRenamed({k: f"_key_{k}" for k in keys}), there)
        found = found.select(*keys, F.col("_from").alias("_lo"), F.col("_to").alias("_hi"), "_q", (F.col("_k") - F.col("_less")).alias("_k"), "_w")
        spent.append(state)
        state = kept(found.unionByName(state.filter("_lo = _hi")), "ranks")
    discard(*spent)
    value_of = lambda q: F.when(F.col("_q") == q.name, F.col("_lo"))
    out = state.groupBy(*keys).agg(*[(F.sum(value_of(q).cast("double") * F.col("_w")) if q.between else F.max(value_of(q)).cast(kind)).alias(q.name) for q in wanted])
    if by:
        return out
    return rows.sparkSession.range(1).select(F.lit(0).alias("one")).join(out, F.col("one") == F.col("_all"), "left").select(*[q.name for q in wanted])


def median_deviation(rows: DataFrame, value: str, by: tuple[str, ...]) -> DataFrame:
    """by, median, mad: the median, and the median of the distances from it."""
    mid = kept(quantiles(rows, value, [median()], by), "medians")
    off = with_keys(rows.select(*by, value), mid, by, "inner").withColumn("_off", F.abs(F.col(value) - F.col("median")))
    return with_keys(mid, quantiles(off, "_off", [median("mad")], by), by, "inner")
