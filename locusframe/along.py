"""Neighbours and ranks along a contig, found in bins of positions.

A bin is one task's work, however large the contig. What it needs from the bins around it (the nearest positions, how many
rows come before) comes from a table with one row a bin. Keys may be null; a null is a contig like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.sources import kept

#: Positions in a bin.
WIDTH = 1 << 16


def binned(rows: DataFrame, at: str = "pos", width: int = WIDTH) -> DataFrame:
    """rows with _bin."""
    return rows.withColumn("_bin", F.floor(F.col(at) / width))


def with_keys(rows: DataFrame, table: DataFrame, keys: tuple[str, ...], how: str = "left") -> DataFrame:
    """rows joined to a table with one row a key, nulls equal to nulls."""
    named = table.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return rows.join(named, same, how).drop(*[f"_key_{k}" for k in keys])


def carried(rows: DataFrame, at: str = "pos", by: tuple[str, ...] = ("contig",)) -> DataFrame:
    """by, _bin, _after (the first position of the next bin), _before (the last of the one before), _rank (rows before the
    bin), _total (rows of the contig). rows has _bin; the ordered pass is over one row a bin."""
    per = rows.groupBy(*by, "_bin").agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.count(F.lit(1)).alias("_size"))
    order = Window.partitionBy(*by).orderBy("_bin")
    return per.select(
        *by,
        "_bin",
        F.lead("_first").over(order).alias("_after"),
        F.lag("_last").over(order).alias("_before"),
        F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_rank"),
        F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )


def neighbours(sites: DataFrame, at: str = "pos", by: tuple[str, ...] = ("contig",), width: int = WIDTH) -> DataFrame:
    """sites with _prev and _next (positions; null at a contig's ends), _i (rank from 0) and _total."""
    rows = binned(sites, at, width)
    keys = (*by, "_bin")
    inner = Window.partitionBy(*keys).orderBy(at)
    rows = rows.withColumn("_lag", F.lag(at).over(inner)).withColumn("_lead", F.lead(at).over(inner)).withColumn("_k", F.row_number().over(inner) - 1)
    rows = with_keys(rows, carried(binned(sites, at, width), at, by), keys)
    rows = rows.withColumn("_prev", F.coalesce("_lag", "_before")).withColumn("_next", F.coalesce("_lead", "_after")).withColumn("_i", F.col("_rank") + F.col("_k"))
    return rows.drop("_bin", "_lag", "_lead", "_k", "_before", "_after", "_rank")


def ranked(rows: DataFrame, *order) -> DataFrame:
    """rows with _i: their rank from 0 in the given order. Sorted partitions are numbered in themselves; how many rows come
    before each is a table with one row a partition."""
    ordered = kept(rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_id", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    begun = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_begun"))
    return ordered.join(F.broadcast(begun), part == F.col("_part")).withColumn("_i", F.col("_begun") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_begun", "_id")
