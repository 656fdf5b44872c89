"""Operators over the spacing of sites along a contig, in bins of positions (see along)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.along import WIDTH, binned, neighbours, with_keys
from locusframe.quantiles import Quantile, quantiles
from locusframe.sources import kept as stored

EXTRA = ("_prev", "_next", "_i", "_total")


def gaps(sites: DataFrame) -> DataFrame:
    """sites with gap: the distance to the next site of the contig (null at its end)."""
    return neighbours(sites).withColumn("gap", F.col("_next") - F.col("pos")).drop(*EXTRA)


def density_filter(sites: DataFrame, k: int, window: int) -> DataFrame:
    """Sites that do not begin a run of k sites within less than `window`; the last k stay if the site before them is at
    least `window` before the end. k of 1 and contigs of at most k sites keep all."""
    if k <= 1:
        return sites
    rows = neighbours(sites)
    # the site k - 1 places further, by its rank
    ahead = rows.select("contig", (F.col("_i") - (k - 1)).alias("_i"), F.col("pos").alias("_pos"))
    rows = with_keys(rows, ahead, ("contig", "_i")).withColumn("_ahead", F.col("_pos") - F.col("pos"))
    ends = neighbours(sites).groupBy("contig").agg((F.max("pos") - F.max(F.when(F.col("_i") == F.col("_total") - k - 1, F.col("pos")))).alias("_span"))
    rows = with_keys(rows, ends, ("contig",))
    tail = F.col("_i") >= F.col("_total") - k
    return rows.filter((F.col("_total") <= k) | F.when(tail, F.col("_span") >= window).otherwise(F.col("_ahead") >= window)).drop("_pos", "_ahead", "_span", *EXTRA)


def far_from_previous(sites: DataFrame, distance: int) -> DataFrame:
    """Sites more than `distance` after the one before, whether that stays or not; a contig's first stays."""
    return neighbours(sites).filter(F.col("_prev").isNull() | (F.col("pos") - F.col("_prev") > distance)).drop(*EXTRA)


def least_gap(sites: DataFrame, distance: int, first: bool = True) -> DataFrame:
    """Sites at least `distance` after the one before; a contig's first stays, or (first=False) is compared to itself."""
    before = F.col("_prev") if first else F.coalesce("_prev", "pos")
    gap = F.col("pos") - before
    return neighbours(sites).filter(gap.isNull() | (gap >= distance)).drop(*EXTRA)


def _following(ps: np.ndarray, distance: int) -> np.ndarray:
    """For each of several ascending positions, the place of the first at least `distance` after it."""
    return np.searchsorted(ps, ps + distance)


#: Bins whose tables meet in one group.
FAN = 256


def thin(sites: DataFrame, distance: int, by: tuple[str, ...] = ("contig",), width: int | None = None) -> DataFrame:
    """Greedy thinning: a site stays if it is at least `distance` after the last one that stayed.

    In bins of `width` positions (a million, 1,000 times the distance at least). The first site of a bin that stays is one of
    those in its first `distance` positions or the next; for each of them a bin tells which site stays last. Such tables, about
    `distance` entries each, are composed: FAN neighbouring bins make the table of a larger bin, and so on up to one a contig;
    down again, every bin gets the last site that stays before it from the larger one that it is in. So no group is larger
    than FAN tables, however long the contig. Then each bin is thinned by itself.
    """
    distance = max(int(distance), 1)
    width = width or max(1 << 20, 1000 * distance)
    fan = FAN
    keys = (*by, "_bin")
    rows = binned(sites.select(*by, "pos").filter("pos is not null").distinct(), "pos", width).withColumn("pos", F.col("pos").cast("long"))
    # bins from 0, so that larger bins end in one
    least = rows.agg(F.min("_bin")).first()[0] or 0
    rows = rows.withColumn("_bin", F.col("_bin") - least)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*by).schema.fields)

    def named(key: tuple, n: int) -> dict[str, pd.Series]:
        return {c: pd.Series([v] * n, dtype=object) for c, v in zip(by, key, strict=False)}

    def table(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        ps = np.sort(part["pos"].to_numpy())
        follows = _following(ps, distance)
        last = np.arange(len(ps))
        for i in range(len(ps) - 1, -1, -1):
            if follows[i] < len(ps):
                last[i] = last[follows[i]]
        start = int(key[-1] + least) * width
        n = int(np.searchsorted(ps, start + distance)) + 1
        return pd.DataFrame({**named(key, 1), "_bin": [key[-1]], "entry": [ps[:n]], "last": [ps[last[:n]]], "start": [start]})

    def after(held: float, entry: np.ndarray, last: np.ndarray) -> float:
        # without an entry far enough, no site of the bin is
        at = 0 if np.isnan(held) else int(np.searchsorted(entry, held + distance))
        return float(last[at]) if at < len(entry) else held

    def composed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_bin")
        entries, lasts = list(part["entry"]), list(part["last"])
        # entries that any site before the larger bin can lead to: those of its first positions, and the next
        entry, owner = np.concatenate(entries), np.repeat(np.arange(len(entries)), [len(e) for e in entries])
        entry, first = np.unique(entry, return_index=True)
        owner = owner[first]
        start = int(part["start"].iloc[0])
        n = min(len(entry), int(np.searchsorted(entry, start + distance)) + 1)
        out = []
        for e, i in zip(entry[:n], owner[:n], strict=True):
            held = float(lasts[i][np.searchsorted(entries[i], e)])
            for j in range(i + 1, len(entries)):
                held = after(held, entries[j], lasts[j])
            out.append(int(held))
        return pd.DataFrame({**named(key, 1), "_bin": [key[-1]], "entry": [entry[:n]], "last": [np.array(out, np.int64)], "start": [start]})

    def begun(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        # what is held before the larger bin, then before each of its bins
        part = part.sort_values("_bin")
        held, out = float(part["held"].iloc[0]), []
        for entry, last in zip(part["entry"], part["last"], strict=True):
            out.append(held)
            held = after(held, entry, last)
        return pd.DataFrame({**named(key, len(out)), "_bin": part["_bin"].to_numpy(), "held": np.array(out, np.float64)})

    def kept(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        ps = np.sort(part["pos"].to_numpy())
        follows, out = _following(ps, distance), []
        held = float(part["held"].iloc[0])
        i = 0 if np.isnan(held) else int(np.searchsorted(ps, held + distance))
        while i < len(ps):
            out.append(ps[i])
            i = follows[i]
        return pd.DataFrame({**named(key, len(out)), "pos": np.array(out, np.int64)})

    table_type, up = f"{own}, _bin long, entry array<long>, last array<long>, start long", F.floor(F.col("_bin") / fan)
    tables = [stored(rows.groupBy(*keys).applyInPandas(table, table_type), "thinning")]
    while (ends := tables[-1].agg(F.min("_bin"), F.max("_bin")).first())[0] is not None and ends[0] < ends[1]:
        larger = tables[-1].withColumn("_up", up)
        tables.append(stored(larger.groupBy(*by, "_up").applyInPandas(composed, table_type), "thinning"))
    nothing = F.lit(float("nan"))
    held = tables[-1].select(*by, "_bin", nothing.alias("held"))
    for level in reversed(tables[:-1]):
        inside = with_keys(level.withColumn("_up", up), held.withColumnRenamed("_bin", "_up"), (*by, "_up"))
        held = stored(inside.groupBy(*by, "_up").applyInPandas(begun, f"{own}, _bin long, held double"), "thinning")
    chosen = with_keys(rows, held, keys).groupBy(*keys).applyInPandas(kept, f"{own}, pos long")
    return with_keys(sites, chosen.withColumn("_kept", F.lit(True)), (*by, "pos"), "left").filter("_kept").drop("_kept")


def binned_gaps(sites: DataFrame, size: int = 100) -> DataFrame:
    """bin, n: how many gaps round to each multiple of size."""
    bin_ = (F.floor((2 * F.col("gap") + size) / (2 * size)) * size).cast("long")
    return gaps(sites).filter("gap is not null").groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def percentile_cutoff(sites: DataFrame, at: float = 0.05) -> DataFrame:
    """cutoff: the nearest-rank percentile of the gaps."""
    return quantiles(gaps(sites), "gap", [Quantile("cutoff", at)]).select(F.col("cutoff").cast("long"))


def bimodal_cutoff(sites: DataFrame, size: int = 100) -> DataFrame:
    """cutoff: mean + 2 standard deviations of the binned gaps below the middle of the two most frequent ones."""
    modes = binned_gaps(sites, size)
    top = modes.orderBy(F.desc("n"), "bin").limit(2).agg((F.sum("bin") / 2.0).alias("middle"))
    low = modes.crossJoin(F.broadcast(top)).filter(F.col("bin") < F.col("middle"))
    # moments of the binned gaps from their counts
    m = low.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("bin")).alias("s"), F.sum(F.col("n") * F.col("bin") * F.col("bin")).alias("q"))
    mean = F.col("s") / F.col("n").cast("double")
    spread = F.sqrt((F.col("q") - F.col("s") * mean) / F.nullif(F.col("n") - 1, F.lit(0)))
    return m.select(F.round(mean + 2 * spread, 6).alias("cutoff"))


def spine(depth: DataFrame, extents: DataFrame) -> DataFrame:
    """contig, pos, depth for every position 1..len, 0 where depth has none."""
    every = extents.filter("len > 0").select("contig", F.explode(F.sequence(F.lit(1).cast("long"), F.col("len"))).alias("pos"))
    return every.join(depth.select("contig", "pos", "depth"), ["contig", "pos"], "left").select("contig", "pos", F.coalesce("depth", F.lit(0)).cast("int").alias("depth"))


def slopes(dense: DataFrame, width: int = 10) -> DataFrame:
    """contig, pos, slope, r2 of depth on position over `width` positions from each on; positions past the end have depth 0."""
    last = dense.groupBy("contig").agg(F.max("pos").alias("last"))
    pad = last.select("contig", F.explode(F.sequence(F.col("last") + 1, F.col("last") + width - 1)).alias("pos"), F.lit(0).alias("depth"), F.lit(True).alias("pad"))
    rows = dense.select("contig", "pos", "depth", F.lit(False).alias("pad")).unionByName(pad)
    # a window that reaches into the next bin finds its first positions here as guests
    own = F.floor(F.col("pos") / WIDTH)
    places = F.when(F.col("pos") - own * WIDTH < width - 1, F.array(own, own - 1)).otherwise(F.array(own))
    rows = rows.withColumn("_bin", F.explode(places)).withColumn("pad", F.col("pad") | (F.col("_bin") != own))
    frame = Window.partitionBy("contig", "_bin").orderBy("pos").rowsBetween(0, width - 1)
    sums = {"n": F.lit(1), "x": F.col("pos"), "y": F.col("depth"), "xx": F.col("pos") * F.col("pos"), "xy": F.col("pos") * F.col("depth"), "yy": F.col("depth") * F.col("depth")}
    rows = rows.select("contig", "pos", "pad", *[F.sum(v.cast("long")).over(frame).alias(k) for k, v in sums.items()]).filter("not pad")
    # whole numbers, so equal in any order of adding
    sxx, sxy, syy = F.expr("n * xx - x * x"), F.expr("n * xy - x * y"), F.expr("n * yy - y * y")
    return rows.select("contig", "pos", (sxy / sxx.cast("double")).alias("slope"), F.when(syy == 0, F.lit(1.0)).otherwise(sxy * sxy / (sxx.cast("double") * syy)).alias("r2"))


def cliffs(dense: DataFrame, slope: float = 5.0, r2: float = 0.7, width: int = 10) -> DataFrame:
    """contig, lo, hi: where depth rises or falls steadily; touching windows join."""
    from locusframe.intervals import union

    steep = slopes(dense, width).filter((F.abs("slope") >= slope) & (F.col("r2") >= r2))
    return union(steep.select("contig", F.col("pos").alias("lo"), (F.col("pos") + width - 1).alias("hi")))
