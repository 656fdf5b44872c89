"""Suffix-array dedup (operator 9): linear-time grouping construction on blocks of text that share an anchor.

A corpus-wide suffix array would need the whole text in one place. Strings of `window` bytes that are equal have equal
anchors (see repeats), so each group of different spans under one anchor is a block of its own: its suffixes are sorted in
linear time and two neighbours that agree for `window` bytes are repeats. A span that recurs as a whole needs no sorting,
only a count. Blocks of up to `block_spans` spans are sorted whole; a larger group, such as a common passage between
thousands of different neighbours, is dealt out by a second key, a hash of the string itself, so that no block grows with
the corpus: strings of one key stand in one block and are counted there.

Defined results: null and empty texts have no bytes; texts shorter than `window` keep all; matches never cross documents;
rows with equal doc_id and text repeat each other; cuts may split a UTF-8 character, so kept bytes are binary.
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


def suffix_array(text: list[int]) -> list[int]:
    """Suffix order by Lyndon-prefix groups.

    Phase 1 handles the groups from the highest to the lowest. For each suffix of a group it follows previous-smaller
    pointers to the nearest suffix before it in a lower group; those found are split off their groups, by how many suffixes
    of this group they lead to, and stand right above the rest. In the end a group holds the suffixes with one Lyndon
    prefix. Phase 2 emits: behind each suffix, taken in order, the chain of previous-smaller pointers lists the suffixes
    whose Lyndon prefix ends there; each goes to the next free place of its group.
    """
    n = len(text)
    if not n:
        return []
    members: list[list[int]] = []
    group = [0] * n
    of: dict[int, int] = {}
    for c in sorted(set(text)):
        of[c] = len(members)
        members.append([])
    for i, c in enumerate(text):
        g = of[c]
        group[i] = g
        members[g].append(i)
    size = [len(x) for x in members]
    above = list(range(1, len(members))) + [-1]
    below = list(range(-1, len(members) - 1))
    previous = [-1] * n
    done = bytearray(n)
    g = len(members) - 1
    top = g
    while g >= 0:
        rows = [i for i in members[g] if group[i] == g]
        count: dict[int, int] = {}
        for i in rows:
            p = i - 1
            while p >= 0 and (done[p] or group[p] == g):
                p = previous[p]
            previous[i] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        for i in rows:
            done[i] = 1
        if count:
            parts: dict[tuple[int, int], list[int]] = {}
            for p, c in count.items():
                parts.setdefault((group[p], c), []).append(p)
            for h, c in sorted(parts, key=lambda x: -x[1]):
                moved = parts[h, c]
                if len(moved) == size[h]:
                    continue
                new = len(members)
                members.append(sorted(moved))
                for p in moved:
                    group[p] = new
                size.append(len(moved))
                size[h] -= len(moved)
                up = above[h]
                above.append(up)
                below.append(h)
                above[h] = new
                if up >= 0:
                    below[up] = new
                else:
                    top = new
        g = below[g]
    bottom = top
    while below[bottom] >= 0:
        bottom = below[bottom]
    slot, at, g = [0] * len(members), 0, bottom
    while g >= 0:
        slot[g] = at
        at += size[g]
        g = above[g]
    order = [-1] * n
    placed = bytearray(n)
    for k in range(-1, n):
        p = (order[k] if k >= 0 else n) - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            order[slot[g]] = p
            slot[g] += 1
            placed[p] = 1
            p = previous[p]
    return order


def repeated_starts(spans: list[bytes], window: int) -> list[np.ndarray]:
    """For each of several different spans, where strings of `window` bytes start that start elsewhere in them too."""
    text: list[int] = []
    starts = []
    for k, span in enumerate(spans):
        starts.append(len(text))
        text.extend(span)
        text.append(256 + k)
    flat = b"".join(span + b"\0" for span in spans)
    last = np.asarray([s + len(x) - window for s, x in zip(starts, spans, strict=True)])
    order = np.asarray(suffix_array(text))
    owner = np.searchsorted(starts, order, "right") - 1
    order = order[order <= last[owner]]
    hit = np.zeros(len(text), bool)
    for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
        if flat[a : a + window] == flat[b : b + window]:
            hit[a] = hit[b] = True
    return [np.flatnonzero(hit[s : s + len(x)]) for s, x in zip(starts, spans, strict=True)]


def span_bytes(tokens: R.Tokens):
    """The bytes of each span asked for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, (lo, n, anchor, span, large) = R.spans_of(batch.column(1))
            data, offsets = A.text_bytes(batch.column(0))
            begin = offsets[row] + lo
            raw = [data[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + n + tokens.window - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(span), pa.array(raw, pa.binary()), pa.array(large)], ["anchor", "span", "raw", "large"])

    return task


#: About so many spans are sorted in one task.
TASK_SPANS = 2000
FOUND = "anchor long, span long, lo array<int>"


def sort_blocks(window: int):
    """Rows (anchor, list of (span, raw)): one block each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, keys, hits = [], [], []
            for anchor, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                different = {x["span"]: x["raw"] for x in block}
                for key, starts in zip(different, repeated_starts(list(different.values()), window), strict=True):
                    if len(starts):
                        anchors.append(anchor)
                        keys.append(key)
                        hits.append(starts.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(keys, pa.int64()), pa.array(hits, pa.list_(pa.int32()))], ["anchor", "span", "lo"])

    return task


def string_keys(window: int):
    """Rows (anchor, span, raw) to a key for each string of `window` bytes: the second key of large groups."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, data, offsets in A.chunks(batch.column(2).cast(pa.large_binary()), A.CHUNK_BYTES // 2):
                sizes = np.maximum(np.diff(offsets) - window + 1, 0)
                row = np.repeat(np.arange(len(sizes)), sizes)
                j = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                begin = offsets[row] + j
                w = A.span_hash(A.prefix(A.BYTE_VALUES[data]), begin, begin + window).view(np.int64)
                take = pa.array(row + at)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(j.astype(np.int32)), pa.array(w)], ["anchor", "span", "j", "w"])

    return task


def cut(tokens: R.Tokens, digest: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, (lo, n) = R.spans_of(batch.column(2))
            order = np.argsort(row, kind="stable")
            row, lo, n = row[order], lo[order].astype(np.int64), n[order].astype(np.int64)
            for at, end, data, offsets in A.chunks(batch.column(1)):
                mine = slice(*np.searchsorted(row, [at, end]))
                begin = offsets[row[mine] - at] + lo[mine]
                gone = R.cover_mask(len(data), begin, begin + n[mine] + tokens.window - 1)
                before = np.zeros(len(data) + 1, bool)
                before[1:] = gone
                before[offsets] = False
                spans = np.concatenate([[0], np.cumsum(gone & ~before[:-1])])[offsets]
                kept = data[~gone]
                to = np.concatenate([[0], np.cumsum(~gone)])[offsets]
                raw = kept.tobytes()
                texts = [raw[a:b] for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]
                total, left = np.diff(offsets), np.diff(to)
                columns = [batch.column(0).slice(at, end - at), pa.array(total), pa.array(total - left), pa.array(np.diff(spans))]
                last = pa.array([hashlib.sha256(x).hexdigest() for x in texts]) if digest else pa.array(texts, pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, last], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"])

    return task


def remove_repeated_bytes(docs: DataFrame, window: int = 400, anchor: int = 160, block_spans: int = 32, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary); digest: kept_sha256 for the last."""
    tokens = R.Tokens("bytes", window, min(anchor, window))
    runs = R.repeated_runs(docs, tokens)
    raw = written(R.mixed_spans(docs, runs, span_bytes(tokens), "anchor long, span long, raw binary, large boolean", block_spans), "spans")
    # as many partitions as keep a task's sorting short, whatever the size of the corpus
    few = raw.filter("not large")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), few.count() // TASK_SPANS)
    blocks = few.repartition(parts, "anchor").groupBy("anchor").agg(F.collect_list(F.struct("span", "raw")).alias("block"))
    small = blocks.mapInArrow(sort_blocks(window), FOUND).select("anchor", "span", F.transform("lo", lambda x: F.struct(x.alias("lo"), F.lit(1).alias("n"))).alias("windows"))
    index = written(raw.filter("large").select("anchor", "span", "raw").mapInArrow(string_keys(window), "anchor long, span long, j int, w long"), "string-keys")
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, {'kept_sha256 string' if digest else 'kept binary'}"
    large, shared = R.windows_found(index)
    return R.covered(docs, runs, small.unionByName(large), cut(tokens, digest), schema, (raw, index, shared))
