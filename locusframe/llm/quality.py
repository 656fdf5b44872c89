"""Quality rules (operator 10): how much of a text stands in repeated word n-grams and lines.

Rolling hashes of several n-gram lengths are sorted inside each text; every word of an n-gram found twice or more counts as
covered, the first occurrence included. `coverage_<n>` is the share of the words' characters that duplicated n-grams of
that length cover, `dup_line_chars` the share of characters in lines equal to an earlier line of the text. A text is kept if
it passes the base rules (at least 50 words, at most half of them in repeated 3-word windows), every share is within its
limit, and so is the number of markup symbols for each character in words.

Defined results: null and empty texts have no words and fail the base rules; shares of a text without words are 0; other
columns pass through `keep_good` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from locusframe.llm import arrays as A

#: Largest allowed share of characters inside duplicated n-grams, by n-gram length; and inside repeated lines.
LIMITS = {3: 0.5, 5: 0.4, 8: 0.35, 12: 0.3}
LINE_LIMIT = 0.3
#: Largest allowed number of symbols for each character in words.
SYMBOL_LIMIT = 0.05
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, coverage array<double>, dup_line_chars double, base_failed boolean, kept boolean"


def duplicated(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """True for each token that an n-gram found twice or more in its row covers."""
    size = len(values)
    out = np.zeros(size, bool)
    if size < n:
        return out
    grams = A.window_hash(A.prefix(values), n)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.flatnonzero(row[: len(grams)] == row[n - 1 :])
    if not len(inside):
        return out
    keys = grams[inside] ^ A.mix(row[inside] + 1)
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.zeros(len(ranked) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    hit = inside[order[same[1:] | same[:-1]]]
    edge = np.zeros(size + 1, np.int32)
    edge[hit] += 1
    np.subtract.at(edge, hit + n, 1)
    return np.cumsum(edge[:size]) > 0


def row_sums(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[offsets])


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts and shares of each row; see the module."""
    rows = len(offsets) - 1
    starts, ends, first = A.words(data, offsets)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    chars = points[ends] - points[starts]
    out = {"n_words": np.diff(first), "word_chars": row_sums(chars, first), "n_symbols": row_sums(_SYMBOL[data], offsets)}
    values = A.word_hashes(data, starts, ends)
    whole = np.maximum(out["word_chars"], 1)
    shares = []
    for n in LIMITS:
        hit = duplicated(values, first, n)
        if n == 3:
            out["n_repeat_words"] = row_sums(hit, first)
        shares.append(row_sums(chars * hit, first) / whole)
    out["coverage"] = np.stack(shares, 1)

    # lines: cut at \n and at row ends; those without a word do not count
    edge = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    lo, hi = edge[:-1], edge[1:].copy()
    hi -= (data[hi - 1] == 10) if len(hi) else 0
    at = np.searchsorted(lo, starts, "right") - 1
    worded = np.unique(at)
    lo, hi = lo[worded], hi[worded]
    line = A.span_hash(A.prefix(A.BYTE_VALUES[data]), lo, hi) ^ A.mix(A.row_of(offsets, lo) + 1)
    order = np.argsort(line, kind="stable")
    again = np.zeros(len(line), bool)
    again[order[1:]] = line[order[1:]] == line[order[:-1]]
    row = A.row_of(offsets, lo)
    out["n_dup_lines"] = np.bincount(row[again], minlength=rows)
    length = points[hi] - points[lo]
    out["dup_line_chars"] = np.bincount(row[again], length[again], minlength=rows) / np.maximum(np.bincount(row, length, minlength=rows), 1)
    out["base_failed"] = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    within = (out["coverage"] <= np.asarray(list(LIMITS.values()))).all(1) & (out["dup_line_chars"] <= LINE_LIMIT) & (out["n_symbols"] <= SYMBOL_LIMIT * whole)
    out["kept"] = ~out["base_failed"] & within
    return out


def assess(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns of docs (default doc_id), then the measures of `text`."""
    columns = columns or ("doc_id",)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            for at, end, data, offsets in A.chunks(batch.column(0)):
                m = measure(data, offsets)
                own = [c.slice(at, end - at) for c in batch.columns[1:]]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(end - at + 1, dtype=np.int32) * len(LIMITS)), pa.array(m["coverage"].ravel()))
                values = [lists if k == "coverage" else pa.array(m[k]) if m[k].dtype.kind in "fb" else pa.array(m[k].astype(np.int64)) for k in names]
                yield pa.RecordBatch.from_arrays([*own, *values], [*columns, *names])

    own = docs.select(*columns).schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.fields), SCHEMA])
    return docs.select(docs["text"].alias("text"), *[docs[c].alias(f"own{i}") for i, c in enumerate(columns)]).mapInArrow(task, schema)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [measure(data, offsets)["kept"] for _, _, data, offsets in A.chunks(batch.column(batch.schema.get_field_index("text")))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(task, docs.schema)
