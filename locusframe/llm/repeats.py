"""Windows of k tokens that occur more than once in a corpus, found without comparing pairs.

Each window is owned by its anchor: the g-gram of the smallest hash in it, the leftmost if tied. Equal windows have equal
anchors at equal offsets, so only windows with the same anchor need comparing. Consecutive windows with one anchor form a
run; a run is one row (anchor, hash of all it spans), about 2 for every k - g + 2 tokens. Then:

* an anchor that occurs once owns no repeated window (most rows end here, after a partial count);
* a span that occurs twice under its anchor repeats all its windows: groups of copies end here, as counts;
* anchors with several different spans ("mixed") need the windows of one representative of each span compared, which is
  what the two operators that use this module do each in its own way.

Rows are keyed by a hash of (doc_id, text), so rows with the same doc_id and different texts stay apart. Hashes have 64
bits, of a polynomial modulo 2^61 - 1; two equal hashes under the same anchor are taken for equal spans (two different ones
agree with a chance of about their length by 2^61). The words or bytes of different spans are compared by the operators.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm import arrays as A
from locusframe.llm.store import discard, written

_U = np.uint64


@dataclass(frozen=True)
class Tokens:
    """How a text becomes tokens: words or bytes; windows have `window` of them, anchors `anchor`."""

    unit: str
    window: int
    anchor: int

    def hashes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a hash for each token, first token of each row and the total)."""
        if self.unit == "bytes":
            return A.BYTE_VALUES[data], offsets
        starts, ends, first = A.words(data, offsets)
        return A.word_hashes(data, starts, ends), first

    def runs(self, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, first window in the row, windows, anchor, span) of each run."""
        k, g, n = self.window, self.anchor, len(values)
        if n < k:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U, _U))
        sums = A.prefix(values)
        grams = A.window_hash(sums, g)
        at = A.sliding_min((grams & _U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=_U), k - g + 1)
        at = (at & _U(0xFFFFFFFF)).astype(np.int64)
        edge = np.zeros(n + 2, np.int32)
        full = np.flatnonzero(np.diff(first) >= k)
        edge[first[full]] += 1
        edge[first[full + 1] - k + 1] -= 1
        inside = np.cumsum(edge)[: len(at)] > 0
        turn = np.ones(len(at) + 1, bool)
        turn[1:-1] = (at[1:] != at[:-1]) | ~inside[1:] | ~inside[:-1]
        lo = np.flatnonzero(inside & turn[:-1])
        hi = np.flatnonzero(inside & turn[1:])
        place = ((at[lo] - lo).astype(_U) << _U(32)) | (hi - lo).astype(_U)
        span = A.mix(A.span_hash(sums, lo, hi + k) ^ A.mix(place))
        row = A.row_of(first, lo)
        return row, lo - first[row], hi - lo + 1, grams[at[lo]], span


def keyed(docs: DataFrame) -> DataFrame:
    """rid, doc_id, text: all that these operators use of a document."""
    return docs.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")


def find_runs(docs: DataFrame, tokens: Tokens) -> DataFrame:
    """rid, lo, n, anchor, span: one row for each run of windows with one anchor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy(zero_copy_only=False)
            for at, _, data, offsets in A.chunks(batch.column(1)):
                row, lo, n, anchor, span = tokens.runs(*tokens.hashes(data, offsets))
                yield pa.RecordBatch.from_arrays([pa.array(rid[at + row]), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(span.view(np.int64))], ["rid", "lo", "n", "anchor", "span"])

    return keyed(docs).select("rid", "text").mapInArrow(task, "rid long, lo int, n int, anchor long, span long")


def repeated_runs(docs: DataFrame, tokens: Tokens) -> DataFrame:
    """The runs whose anchor occurs more than once; mixed: under that anchor stand different spans."""
    runs = written(find_runs(docs, tokens), "runs")
    anchors = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.min("span").alias("a"), F.max("span").alias("b")).filter("c > 1").select("anchor", (F.col("a") != F.col("b")).alias("mixed"))
    # written, so that both sides of the join are plain exchanges, of which Spark splits the large partitions of hot anchors
    anchors = written(anchors, "anchors")
    out = written(runs.join(anchors, "anchor"), "repeated-runs")
    discard(runs, anchors)
    return out


def mixed_spans(docs: DataFrame, runs: DataFrame, task: Callable, schema: str, block: int | None = None) -> DataFrame:
    """task over rows (text, list of (lo, n, anchor, span)): one representative for each span under a mixed anchor.

    block: the list's structs also have `large`, whether the anchor has more spans than that.
    """
    one = runs.filter("mixed").groupBy("anchor", "span").agg(F.min(F.struct("rid", "lo", "n")).alias("at"))
    fields = [F.col("at.lo").alias("lo"), F.col("at.n").alias("n"), "anchor", "span"]
    if block is not None:
        one = written(one, "one-of-each")
        large = written(one.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > block).select("anchor", F.lit(True).alias("large")), "large")
        one = one.join(large, "anchor", "left")
        fields.append(F.coalesce("large", F.lit(False)).alias("large"))
    wanted = one.groupBy(F.col("at.rid").alias("rid")).agg(F.collect_list(F.struct(*fields)).alias("spans"))
    return keyed(docs).select("rid", "text").join(wanted, "rid").select("text", "spans").mapInArrow(task, schema)


def spans_of(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row of each struct in a list column, each field as an array)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten()
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), [x.to_numpy(zero_copy_only=False) for x in flat.flatten()]


def covered(docs: DataFrame, runs: DataFrame, found: DataFrame, finish: Callable, schema: str, spent: tuple[DataFrame, ...] = (), sources: bool = False) -> DataFrame:
    """finish over every row (doc_id, text, list of (lo, n) of repeated windows); found: anchor, span, list of windows.

    sources: the lists also have where else the windows stand (source, a row key, and there, the place in it), and found's
    windows have ref, the other span under the anchor, and there, the place in that. spent: tables that only found reads.
    """
    kind = "array<struct<lo:int,n:int,source:bigint,there:int>>" if sources else "array<struct<lo:int,n:int>>"
    none = F.array().cast(kind)
    ends = [F.min(F.struct("rid", "lo")).alias("one"), F.max(F.struct("rid", "lo")).alias("other")] if sources else []
    spans = runs.groupBy("anchor", "span").agg(F.count(F.lit(1)).alias("c"), F.first("mixed").alias("mixed"), *ends)
    extra = ["one", "other"] if sources else []
    if sources:
        # the references of the mixed spans' factors: where the other span first stands
        first = spans.filter("mixed").select("anchor", F.col("span").alias("ref"), F.col("one").alias("at"))
        found = found.select("anchor", "span", F.explode("windows").alias("x")).select("anchor", "span", "x", "x.ref").join(first, ["anchor", "ref"])
        found = found.groupBy("anchor", "span").agg(F.collect_list(F.struct("x.lo", "x.n", F.col("at.rid").alias("source"), (F.col("at.lo") + F.col("x.there")).alias("there"))).alias("windows"))
    spans = spans.filter("c > 1 or mixed").join(found, ["anchor", "span"], "left")
    spans = spans.select("anchor", "span", *extra, F.when(F.col("c") > 1, F.lit(None)).otherwise(F.coalesce("windows", none)).alias("windows"))
    spans = written(spans, "spans-found")
    discard(*spent)
    rows = runs.join(spans, ["anchor", "span"])
    if sources:
        mine = F.struct("rid", "lo") == F.col("one")
        elsewhere = F.when(mine, F.col("other")).otherwise(F.col("one"))
        whole = F.struct("lo", "n", elsewhere["rid"].alias("source"), elsewhere["lo"].alias("there"))
        moved = lambda w: F.struct((F.col("lo") + w["lo"]).alias("lo"), w["n"].alias("n"), w["source"].alias("source"), w["there"].alias("there"))
    else:
        whole = F.struct("lo", "n")
        moved = lambda w: F.struct((F.col("lo") + w["lo"]).alias("lo"), w["n"].alias("n"))
    hits = rows.select("rid", F.when(F.col("windows").isNull(), F.array(whole)).otherwise(F.transform("windows", moved)).alias("windows"))
    hits = hits.filter(F.size("windows") > 0).groupBy("rid").agg(F.flatten(F.collect_list("windows")).alias("windows"))
    return keyed(docs).join(hits, "rid", "left").select("doc_id", "text", F.coalesce("windows", none).alias("windows")).mapInArrow(finish, schema)


def windows_found(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anchor, span, windows from an index of windows (anchor, span, j, w): those that stand in two different spans; a table
    that this reads)."""
    shared = index.groupBy("anchor", "w").agg(F.min("span").alias("a"), F.max("span").alias("b")).filter("a != b").select("anchor", "w")
    shared = written(shared, "shared")
    hits = index.join(shared, ["anchor", "w"]).select("anchor", "span", "j").distinct()
    return hits.groupBy("anchor", "span").agg(F.collect_list(F.struct(F.col("j").alias("lo"), F.lit(1).alias("n"))).alias("windows")), shared


def cover_mask(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True where some [start, end) covers a token."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:n]) > 0
