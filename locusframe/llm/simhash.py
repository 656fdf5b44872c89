"""SimHash near-dedup with bit-sliced comparison (operator 8).

A text's fingerprint: each of 64 bits is 1 if it is set in over half of the XXH64 values of the text's 3-word shingles.
Texts link if their fingerprints differ in at most `radius` bits; a class is what links join.

Search: the 64 bits are cut into radius + 4 blocks. Two fingerprints within the radius agree on all but `radius` blocks, so
each choice of blocks to ignore gives a table in which they share a key. Only different fingerprints enter the tables, so
copies cost one row. A bucket of more than `most` fingerprints is replaced by those of finer tables: the bits that its table
ignores are cut into radius + 4 blocks again, so no link is lost, and a finer bucket holds no more than 2^(bits of `radius`
such blocks) fingerprints, 256 for a radius of 2. Within a bucket, candidates stand in blocks of 64 with their bits stored
vertically; a query updates 64 distances at a time with carry-save counters, and a block is left as soon as all its
candidates exceed the radius. Links become a star within each task, and the classes come from repeated min-label joins over
those stars.

Defined results: null and empty texts have fingerprint 0, linked like any other; the class of a null doc_id's text is the
smallest non-null doc_id of the class, or null; repeated rows are in one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm import arrays as A
from locusframe.llm.store import written

SEED = 42
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SIXTEENTHS = _U(0x0001000100010001)


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = 3) -> np.ndarray:
    starts, ends, first = A.words(data, offsets)
    rows = len(offsets) - 1
    if not len(starts):
        return np.zeros(rows, _U)
    # all words joined by one space; shingles are slices of it
    sizes = ends - starts + 1
    flat = A.gather(np.append(_LOWER[data], np.uint8(32)), starts, ends + 1)
    stop = np.cumsum(sizes) - 1
    flat[stop] = 32
    begin = stop - sizes + 1
    count = np.diff(first)
    made = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    lo = np.repeat(first[:-1], made) + np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
    hi = np.minimum(lo + shingle - 1, np.repeat(first[1:], made) - 1)
    raw, digest = flat.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin[lo].tolist(), stop[hi].tolist(), strict=True)), _U, len(lo))
    # bit counts: 4 counters of 16 bits in a word, over stretches of fewer than 2^16 shingles
    bounds = np.concatenate([[0], np.cumsum(made)])
    cuts = np.unique(np.concatenate([bounds[:-1][made > 0], np.arange(0, len(h), 1 << 15)]))
    owner = np.searchsorted(bounds, cuts, "right") - 1
    out = np.zeros(rows, _U)
    for j in range(16):
        packed = np.add.reduceat((h >> _U(j)) & _SIXTEENTHS, cuts)
        for lane in range(4):
            n = np.bincount(owner, ((packed >> _U(16 * lane)) & _U(0xFFFF)).astype(np.float64), minlength=rows)
            out |= (2 * n > made).astype(_U) << _U(16 * lane + j)
    return out


def with_fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """rid (a hash of doc_id and text), doc_id, fp (the 64 bits as a signed long)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in A.chunks(batch.column(2)):
                own = [batch.column(i).slice(at, end - at) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(fingerprints(data, offsets, shingle).view(np.int64))], ["rid", "doc_id", "fp"])

    return docs.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text").mapInArrow(task, "rid long, doc_id long, fp long")


def tables(radius: int, within: int = (1 << 64) - 1) -> list[int]:
    """The masks of the bits that make the keys: all but `radius` of radius + 4 blocks of the bits in `within`."""
    bits = [1 << i for i in range(64) if within >> i & 1]
    edges = np.linspace(0, len(bits), radius + 5).round().astype(int)
    blocks = [sum(bits[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    whole = (1 << 64) - 1
    return [whole ^ sum(skip) for skip in combinations(blocks, radius)]


def bit_sliced_links(fp: np.ndarray, group: np.ndarray, radius: int, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions i > j of one group (groups are contiguous) whose fingerprints differ in at most radius bits."""
    n = len(fp)
    width = -(-n // 64)
    bits = np.unpackbits(np.concatenate([fp, np.zeros(width * 64 - n, _U)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.reshape(width, 64, 64).transpose(2, 0, 1), axis=2, bitorder="little")).view(_U)[:, :, 0]
    start = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), np.arange(n), 0))
    lo = start // 64
    counts = np.arange(n) // 64 - lo + 1  # a query meets the blocks from its group's start up to itself
    steps = max(1, radius.bit_length())
    left, right = [], []
    cut = np.searchsorted(np.cumsum(counts), np.arange(most, counts.sum() + most, most), "right")
    begin = 0
    for end in np.unique(np.maximum(np.append(cut, n), 0)):
        if end <= begin:
            continue
        q = np.repeat(np.arange(begin, end), counts[begin:end])
        c = counts[begin:end]
        b = np.repeat(lo[begin:end], c) + np.arange(len(q)) - np.repeat(np.cumsum(c) - c, c)
        begin = end
        # candidates of the query's group that stand before it
        low = np.clip(start[q] - b * 64, 0, 63).astype(_U)
        high = np.clip(q - b * 64, 0, 64)
        alive = np.where(high >= 64, ~_U(0), (_U(1) << np.minimum(high, 63).astype(_U)) - _U(1)) & ~((_U(1) << low) - _U(1))
        counter = [np.zeros(len(q), _U) for _ in range(steps)]
        for p in range(64):
            carry = planes[p][b] ^ (_U(0) - ((fp[q] >> _U(p)) & _U(1)))
            for k in range(steps):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            alive &= ~carry
            if p % 8 == 7:
                over = np.zeros(len(q), _U)
                for value in range(radius + 1, 1 << steps):
                    equal = ~_U(0)
                    for k in range(steps):
                        equal = equal & (counter[k] if value >> k & 1 else ~counter[k])
                    over |= equal
                alive &= ~over
                stay = np.flatnonzero(alive)
                if len(stay) < 0.7 * len(q):
                    q, b, alive, counter = q[stay], b[stay], alive[stay], [x[stay] for x in counter]
        stay = np.flatnonzero(alive)
        if len(stay):
            row, at = np.nonzero(np.unpackbits(alive[stay].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            left.append(q[stay][row])
            right.append(b[stay][row] * 64 + at)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that links join to each of n positions."""
    label = np.arange(n)
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(old, label):
            return label


def _long(mask: int):
    return F.lit(mask - (1 << 64) if mask >> 63 else mask)


def buckets(distinct: DataFrame, radius: int, most: int) -> DataFrame:
    """t, key, fp: the fingerprints (column fp) under every key that several share, at most `most` of them or few of a finer table."""
    masks = tables(radius)
    finer = [tables(radius, within=(1 << 64) - 1 - mask) for mask in masks]
    keys = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_long(m)).alias("key")) for t, m in enumerate(masks)])).alias("k")).select("k.t", "k.key", "fp")
    shared = keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    own = F.array(*[F.array(_long(m)) for m in masks])
    split = F.array(*[F.array(*[_long(m) for m in line]) for line in finer])
    used = F.when(F.col("c") > most, split[F.col("t")]).otherwise(own[F.col("t")])
    # keys of a table and of its finer ones never meet: their buckets differ in the table's own bits
    return keys.join(shared, ["t", "key"]).select("t", "fp", F.posexplode(used).alias("part", "mask")).select((F.col("t") * len(finer[0]) + F.col("part")).alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def links(distinct: DataFrame, radius: int, most: int = 4096) -> DataFrame:
    """a < b: links between different fingerprints (column fp), thinned to a star for each connected part of a task."""
    rows = buckets(distinct, radius, most).repartition("t", "key").sortWithinPartitions("t", "key", "fp")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit(t, key, fp):
            group = np.concatenate([[0], np.cumsum((t[1:] != t[:-1]) | (key[1:] != key[:-1]))])
            a, b = bit_sliced_links(fp.view(_U), group, radius)
            used, inverse = np.unique(fp, return_inverse=True)
            label = stars(len(used), inverse[a], inverse[b])
            low, high = used[label], used
            new = low != high
            return pa.RecordBatch.from_arrays([pa.array(low[new]), pa.array(high[new])], ["a", "b"])

        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            held = [np.concatenate(x) for x in zip(held, now, strict=True)] if held else now
            t, key, _ = held
            last = int(np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (key[1:] != key[:-1])]))[-1])
            if last:
                yield emit(*[x[:last] for x in held])
                held = [x[last:] for x in held]
        if held:
            yield emit(*held)

    return rows.mapInArrow(task, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """v, label: the smallest node that edges (a, b) join to each node that is not the smallest itself.

    Alternates two star steps: every node sends its larger neighbours, then its smaller ones, to its smallest neighbour.
    Each round is written, so that lineage stays short and a lost executor costs no more than a round.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        low = edges.groupBy("b").agg(F.min("a").alias("m"))
        small = edges.join(low, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        edges = written(small.filter("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("b").alias("v"), F.col("a").alias("label"))
        seen = state


def _labelled(docs: DataFrame, radius: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(rid, doc_id, fp of each row; for each fp its class and the class's first row)."""
    prints = written(with_fingerprints(docs, shingle), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    least = prints.groupBy("fp").agg(F.min(first).alias("least"))
    label = components(links(least.select("fp"), radius))
    named = written(least.join(label, least["fp"] == label["v"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label")), "labels")
    smallest = named.groupBy("label").agg(F.min("least").alias("kept"))
    return prints, named.join(smallest, "label").select("fp", "kept")


def classes(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id of the class)."""
    prints, of = _labelled(docs, radius, shingle)
    return prints.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("kept.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """One row of docs for each class, the one of the smallest doc_id (of several texts with it, the smallest hash)."""
    _, of = _labelled(docs, radius, shingle)
    kept = of.select(F.col("kept.rid").alias("kept_rid")).distinct()
    rows = docs.join(kept, F.xxhash64(docs["doc_id"], docs["text"]) == kept["kept_rid"], "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])
