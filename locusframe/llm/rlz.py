"""Substring dedup by relative Lempel-Ziv parsing (operator 6).

Documents are factored against an index of reference blocks (the digest form covers the same words without joining factors). A block is the span of a run of word windows
(see repeats); its first occurrence in order of (row key, place) is the reference. A run that recurs as a whole copies its
block. Where runs under one anchor differ, as at the ends of a copied passage, the index of the blocks' windows names for each
window the first block that has it too, and the factor is extended from there in both directions, word by word on the words
themselves, as far as the blocks agree. Factors of `window` words or more become duplicate spans; those that go on in the same
reference are one factor. So every word of a window that stands elsewhere lies in a factor, and no other word does.

Exact but for hashes: that two runs are equal as a whole is taken from two 61-bit hashes, of the anchor and of the span.

Defined results: null and empty texts have no words; a text of fewer than `window` words keeps them all; rows with equal
doc_id and text are occurrences of each other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm import arrays as A
from locusframe.llm import repeats as R
from locusframe.llm.store import written

RESULT = "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<lo:int,n:int>>, factors array<struct<lo:int,n:int,source:long,source_lo:int>>"
INDEX = "anchor long, span long, j int, w long, words binary"


def block_windows(tokens: R.Tokens):
    """A row for each window of a block; the first also has the block's words, joined by spaces."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, (lo, n, anchor, span) = R.spans_of(batch.column(1))
            order = np.argsort(row, kind="stable")
            row, lo, n, anchor, span = row[order], lo[order], n[order].astype(np.int64), anchor[order], span[order]
            for at, end, data, offsets in A.chunks(batch.column(0)):
                mine = slice(*np.searchsorted(row, [at, end]))
                sizes = n[mine]
                if not sizes.sum():
                    continue
                starts, ends, first = A.words(data, offsets)
                head = np.cumsum(sizes) - sizes
                inner = np.arange(sizes.sum()) - np.repeat(head, sizes)
                origin = first[row[mine] - at] + lo[mine]
                begin = np.repeat(origin, sizes) + inner
                window = A.span_hash(A.prefix(A.word_hashes(data, starts, ends)), begin, begin + tokens.window).view(np.int64)
                raw = data.tobytes()
                words = [None] * len(inner)
                for i, a, b in zip(head.tolist(), origin.tolist(), (origin + sizes + tokens.window - 1).tolist(), strict=True):
                    words[i] = b" ".join([raw[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(anchor[mine], sizes)), pa.array(np.repeat(span[mine], sizes)), pa.array(inner.astype(np.int32)), pa.array(window), pa.array(words, pa.binary())], ["anchor", "span", "j", "w", "words"])

    return task


def extend(own: list[bytes], other: list[bytes], at: int, there: int) -> tuple[int, int]:
    """The words of own around place `at` that agree with other's around place `there`: (first, end)."""
    lo, shift = at, there - at
    while lo > 0 and lo + shift > 0 and own[lo - 1] == other[lo + shift - 1]:
        lo -= 1
    hi = at
    while hi < len(own) and hi + shift < len(other) and own[hi] == other[hi + shift]:
        hi += 1
    return lo, hi


def block_factors(window: int):
    """Rows (anchor, span, at, ref, there, words, ref_words) to factors: anchor, span, ref, lo, n (windows), there."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out = [], []
            for i, (at, there, own, other) in enumerate(zip(*(batch.column(k).to_pylist() for k in (2, 4, 5, 6)), strict=True)):
                lo, hi = extend(own.split(b" "), other.split(b" "), at, there)
                if hi - lo >= window:
                    keep.append(i)
                    out.append((lo, hi - lo - window + 1, lo + there - at))
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in (0, 1, 3)), *(pa.array([x[k] for x in out], pa.int32()) for k in range(3))], ["anchor", "span", "ref", "lo", "n", "there"])

    return task


def factors(index: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(anchor, span, windows (lo, n, ref, there): each block's factors against the other blocks under its anchor; a table
    that this reads)."""
    block = F.struct("span", "j")
    shared = index.groupBy("anchor", "w").agg(F.min(block).alias("a"), F.max(block).alias("b")).filter("a.span <> b.span")
    shared = written(shared, "shared")
    hits = index.select("anchor", "span", "j", "w").join(shared, ["anchor", "w"])
    hits = hits.withColumn("r", F.when(F.col("span") == F.col("a.span"), F.col("b")).otherwise(F.col("a")))
    # under one anchor the windows that two blocks share lie side by side, so any of them leads to the factor
    pairs = hits.groupBy("anchor", "span", F.col("r.span").alias("ref")).agg(F.min(F.struct("j", F.col("r.j").alias("there"))).alias("m"))
    texts = index.filter("words is not null").select("anchor", "span", "words")
    rows = pairs.select("anchor", "span", F.col("m.j").alias("at"), "ref", F.col("m.there").alias("there")).join(texts, ["anchor", "span"])
    rows = rows.join(texts.select("anchor", F.col("span").alias("ref"), F.col("words").alias("ref_words")), ["anchor", "ref"])
    found = rows.select("anchor", "span", "at", "ref", "there", "words", "ref_words").mapInArrow(block_factors(window), "anchor long, span long, ref long, lo int, n int, there int")
    return found.groupBy("anchor", "span").agg(F.collect_list(F.struct("lo", "n", "ref", "there")).alias("windows")), shared


def joined(lo: np.ndarray, hi: np.ndarray, source: np.ndarray, there: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first word, words, source, place there) of a text's factors, those that go on in the same reference as one."""
    out: list[list[int]] = []
    for a, b, s, t in sorted(zip(lo.tolist(), hi.tolist(), source.tolist(), there.tolist(), strict=True)):
        if out and s == out[-1][2] and t - a == out[-1][3] - out[-1][0] and a <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], b - out[-1][0])
        elif not out or b > out[-1][0] + out[-1][1]:
            out.append([a, b - a, s, t])
    return [tuple(x) for x in out]


def parse(tokens: R.Tokens, digest: bool):
    """Join repeated windows to factors; drop the words that factors cover. digest: SHA-256 instead of the text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, (lo, n, source, there) = R.spans_of(batch.column(2))
            order = np.argsort(row, kind="stable")
            row, lo, n, source, there = row[order], lo[order].astype(np.int64), n[order].astype(np.int64), source[order], there[order]
            for at, end, data, offsets in A.chunks(batch.column(1)):
                starts, ends, first = A.words(data, offsets)
                mine = slice(*np.searchsorted(row, [at, end]))
                begin = first[row[mine] - at] + lo[mine]
                gone = R.cover_mask(len(starts), begin, begin + n[mine] + tokens.window - 1)
                kept = np.flatnonzero(~gone)
                per_row = np.searchsorted(kept, first)
                # each kept word with the byte after it, which becomes a space
                sizes = ends[kept] - starts[kept] + 1
                out = A.gather(np.append(data, np.uint8(32)), starts[kept], ends[kept] + 1)
                out[np.cumsum(sizes) - 1] = 32
                to = np.concatenate([[0], np.cumsum(sizes)])[per_row]
                raw = out.tobytes()
                texts = [raw[a : max(a, b - 1)] for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]
                total, left = np.diff(first), np.diff(per_row)
                columns = [batch.column(0).slice(at, end - at), pa.array(total), pa.array(total - left)]
                if digest:
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([hashlib.sha256(x).hexdigest() for x in texts])], ["doc_id", "n_words", "n_removed", "kept_sha256"])
                    continue
                edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
                a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                cuts = np.unique(np.concatenate([a, first[(first > 0) & (first < len(gone))]]))
                cuts = cuts[gone[cuts]] if len(gone) else cuts
                stops = np.minimum(b[np.searchsorted(b, cuts, "right")], first[A.row_of(first, cuts) + 1]) if len(cuts) else cuts
                r = A.row_of(first, cuts)
                spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(end - at + 1)).astype(np.int32)), pa.StructArray.from_arrays([pa.array((cuts - first[r]).astype(np.int32)), pa.array((stops - cuts).astype(np.int32))], ["lo", "n"]))
                bounds = np.searchsorted(row, np.arange(at, end + 1))
                parsed = [joined(lo[a:b], lo[a:b] + n[a:b] + tokens.window - 1, source[a:b], there[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                parsed = pa.array([[dict(zip(("lo", "n", "source", "source_lo"), x, strict=True)) for x in p] for p in parsed], pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32()), ("source", pa.int64()), ("source_lo", pa.int32())])))
                yield pa.RecordBatch.from_arrays([*columns, pa.array([x.decode("utf-8", "replace") for x in texts]), spans, parsed], ["doc_id", "n_words", "n_removed", "kept_text", "spans", "factors"])

    return task


def remove_repeats(docs: DataFrame, window: int = 35, anchor: int = 10, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, spans (word offset and length of what was removed), factors (the same, with the
    row key, xxhash64 of doc_id and text, of the reference and the place there); digest: kept_sha256 for the last three."""
    tokens = R.Tokens("words", window, min(anchor, window))
    runs = R.repeated_runs(docs, tokens)
    index = written(R.mixed_spans(docs, runs, block_windows(tokens), INDEX), "block-windows")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" if digest else RESULT
    found, shared = factors(index, window)
    return R.covered(docs, runs, found, parse(tokens, digest), schema, (index, shared), sources=True)
