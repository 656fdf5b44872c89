"""Near copies (the pipeline's second stage): SimHash and min-hash candidates, checked by Jaccard similarity.

A text's set: the 64-bit hashes of its five-word shingles (lower case in ASCII, words joined by one space; a shorter text is one
shingle). Two texts link if their sets have a similarity of at least 4/5, compared in whole numbers; a class is what links
join. Equal hashes count as equal shingles.

Search: equal sets are one row. Candidates come from two sides, and every one is checked on the whole sets:

1. SimHash: the classes of operator 8 (fingerprints that differ in 2 bits at most), each set with its class's smallest;
2. min-hashes, for near copies whose fingerprints lie further apart: BANDS keys of ROWS min-hashes each bring sets together; two
   sets of similarity 4/5 share no key with a chance of (1 - 0.8^4)^26, about one in a million. In each bucket every set is
   paired with the bucket's head, another one in each bucket, so that most of a large class of near copies is joined by at most
   BANDS checks a set;
3. in buckets that still hold several classes, all pairs across them, in the first bucket that a pair shares. A bucket is cut into
   blocks of about SIDE sets and every two blocks are a row: pairs are made in numpy inside a task, only their links leave it,
   fewer than sets. A first pass of blocks, without whole sets, finds which sets have a pair to check; only those get them.

In 2 and 3, only pairs whose min-hashes agree at AGREE or more of 104 places are checked (83 are expected at 4/5, five standard
deviations more than AGREE).

Texts are moved only if a bounded table of bits (MARKS words) does not rule them out: those whose sets are compared, and at the
end those of repeated rows and rows that may go.

Defined results: null and empty texts are one class; the row that stays is that of the smallest doc_id, null last (of several
texts with it, the smallest hash); repeated rows are one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm import arrays as A
from locusframe.llm import simhash as S
from locusframe.llm.simhash import _LOWER, components
from locusframe.llm.store import written

SHINGLE = 5
BANDS, ROWS = 26, 4
AGREE = 62
SIDE = 256
#: Eight bytes of min-hashes make a long.
PACKED = BANDS * ROWS // 8
#: Words of 64 bits that mark row keys; the table goes to all tasks, however many rows there are.
MARKS = 1 << 17
_U = np.uint64
_KEYS = A.mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=_U)).reshape(2, -1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): row i's set is hashes[bounds[i]:bounds[i + 1]], ascending."""
    starts, ends, first = A.words(data, offsets)
    rows = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, _U), np.zeros(rows + 1, np.int64)
    sums = A.prefix(A.word_hashes(_LOWER[data], starts, ends))
    count = np.diff(first)
    made = np.where(count > 0, np.maximum(count - SHINGLE + 1, 1), 0)
    lo = np.repeat(first[:-1], made) + np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
    h = A.span_hash(sums, lo, np.minimum(lo + SHINGLE, np.repeat(first[1:], made)))
    owner = np.repeat(np.arange(rows), made)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
    return h[new], np.searchsorted(owner[new], np.arange(rows + 1))


def min_hashes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minima for each row with a set that is not empty."""
    at = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(at), BANDS * ROWS), _U)
    if len(at):
        for j in range(BANDS * ROWS):
            out[:, j] = np.minimum.reduceat((h ^ _KEYS[0, j]) * (_KEYS[1, j] | _U(1)), at)
    return out


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def with_sketches(docs: DataFrame) -> DataFrame:
    """rid (a hash of doc_id and text), doc_id, s (a hash of the set), n (its size), fp (the SimHash fingerprint), keys (one a
    band), mins (a byte each)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in A.chunks(batch.column(2)):
                h, bounds = shingle_sets(data, offsets)
                sums = np.concatenate([np.zeros(1, _U), np.cumsum(A.mix(h), dtype=_U)])
                full = np.diff(bounds) > 0
                mins = min_hashes(h, bounds)
                keys = np.zeros((len(mins), BANDS), _U)
                for k in range(ROWS):
                    keys = A.mix(keys ^ mins[:, k::ROWS])
                ends = np.concatenate([[0], np.cumsum(full)])
                own = [batch.column(i).slice(at, end - at) for i in range(2)]
                made = [
                    pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(S.fingerprints(data, offsets).view(np.int64)),
                    _lists(keys.view(np.int64).ravel(), ends * BANDS),
                    _lists(np.ascontiguousarray((mins >> _U(40)).astype(np.uint8)).view(np.int64).ravel(), ends * PACKED),
                ]
                yield pa.RecordBatch.from_arrays([*own, *made], ["rid", "doc_id", "s", "n", "fp", "keys", "mins"])

    rows = docs.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")
    return rows.mapInArrow(task, "rid long, doc_id long, s long, n long, fp long, keys array<long>, mins array<long>")


def with_sets(texts: DataFrame) -> DataFrame:
    """s, hashes: the set of each text (s, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in A.chunks(batch.column(1)):
                h, bounds = shingle_sets(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), _lists(h.view(np.int64), bounds)], ["s", "hashes"])

    return texts.select("s", "text").mapInArrow(task, "s long, hashes array<long>")


def marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """rows and `hit`: false only for rows whose rid (a hash) is not among those of keys, so that these need not be moved."""
    word, bit = F.pmod("rid", F.lit(MARKS)).alias("word"), "cast(shiftrightunsigned(rid, 40) & 63 as int)"
    table = keys.groupBy(word).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("bits"))
    return rows.withColumn("word", word).join(F.broadcast(table), "word", "left").withColumn("hit", F.expr(f"coalesce(shiftrightunsigned(bits, {bit}) & 1L, 0L) = 1L")).drop("word", "bits")


def similar(common: Column, n: Column, m: Column) -> Column:
    return 5 * common >= 4 * (n + m - common)


def agreeing(a: Column, b: Column) -> Column:
    """In how many bytes two arrays of PACKED longs agree."""
    out = F.lit(8 * PACKED)
    for i in range(PACKED):
        x = a[i].bitwiseXOR(b[i])
        for shift in (4, 2, 1):  # the lowest bit of each byte becomes 1 if any of its bits is
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        out = out - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return out


def sets_of(docs: DataFrame, sets: DataFrame, used: DataFrame) -> DataFrame:
    """s, hashes: the whole sets of those used (s)."""
    wanted = written(sets.select("s", F.col("least.rid").alias("rid")).join(used, "s", "left_semi"), "wanted")
    rows = marked(docs.select(F.xxhash64("doc_id", "text").alias("rid"), "text"), wanted).filter("hit")
    return with_sets(rows.select("rid", "text").join(wanted, "rid").dropDuplicates(["rid"]))


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """a < b: sets whose texts operator 8 joins, each with the smallest of its class."""
    held = prints.select("fp", "s").distinct()
    label = components(S.links(held.select("fp").distinct(), radius=2))
    named = written(held.join(label, F.col("fp") == F.col("v"), "left").select("s", F.coalesce("label", "fp").alias("c")).distinct(), "fingerprint-classes")
    least = named.groupBy("c").agg(F.min("s").alias("a"), F.count(F.lit(1)).alias("of")).filter("of > 1")
    return named.join(least, "c").filter("s <> a").select("a", F.col("s").alias("b"))


class Block:
    """The sets of a block: s, label, n, min-hashes (a byte each), keys, and, if given, the hashes of all, cut at bounds."""

    def __init__(self, rows: pa.Array):
        column = lambda name: rows.field(name).to_numpy(zero_copy_only=False)
        self.s, self.label, self.n = column("s"), column("label"), column("n")
        self.mins = rows.field("mins").flatten().to_numpy().view(np.uint8).reshape(len(rows), -1)
        self.keys = rows.field("keys").flatten().to_numpy().reshape(len(rows), -1)
        if rows.type.get_field_index("hashes") >= 0:
            hashes = rows.field("hashes")
            self.bounds = np.concatenate([[0], np.cumsum(hashes.value_lengths().to_numpy())])
            self.hashes = hashes.flatten().to_numpy().view(_U)

    def at(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def likely_pairs(t: int, left: Block, right: Block, same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(i, places j): pairs across classes whose first common key is in band t and whose sizes and min-hashes agree enough."""
    use = left.label[:, None] != right.label
    use &= 5 * np.minimum(left.n[:, None], right.n) >= 4 * np.maximum(left.n[:, None], right.n)
    if same:
        use &= np.arange(len(left.s))[:, None] < np.arange(len(right.s))
    for band in range(t):
        use &= left.keys[:, band, None] != right.keys[:, band]
    for i in np.flatnonzero(use.any(axis=1)).tolist():
        j = np.flatnonzero(use[i])
        j = j[(left.mins[i] == right.mins[j]).sum(axis=1) >= AGREE]
        if len(j):
            yield i, j


def similar_pairs(t: int, left: Block, right: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Likely pairs whose whole sets have a similarity of at least 4/5."""
    ones, others = [], []
    for i, j in likely_pairs(t, left, right, same):
        mine = left.at(i)
        theirs = A.gather(right.hashes, right.bounds[j], right.bounds[j + 1])
        hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
        common = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(right.n[j])[:-1]]), dtype=np.int64)
        j = j[5 * common >= 4 * (left.n[i] + right.n[j] - common)]
        ones.append(np.full(len(j), i))
        others.append(j)
    none = np.zeros(0, np.int64)
    return (np.concatenate(ones), np.concatenate(others)) if ones else (none, none)


def in_blocks(rows: DataFrame, columns: list[str], name: str, task: Callable, schema: str) -> DataFrame:
    """task(t, key, block, another, whether they are one) of every two blocks of each bucket (rows t, key, s and the columns)."""
    sizes = rows.groupBy("t", "key").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("blocks"), F.count(F.lit(1)).alias("c"))
    sizes = written(sizes, f"{name}-sizes")
    block = F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int")
    lists = rows.join(sizes, ["t", "key"]).groupBy("t", "key", "blocks", block.alias("x")).agg(F.collect_list(F.struct(*columns)).alias("l"))
    lists = written(lists, f"{name}-blocks")
    left = lists.select("t", "key", "x", "l", F.explode(F.sequence("x", F.col("blocks") - 1)).alias("y"))
    both = left.join(lists.select("t", "key", F.col("x").alias("y"), F.col("l").alias("r")), ["t", "key", "y"]).select("t", "x", "y", "l", "r", "key")
    dealt = sizes.agg(F.coalesce(F.sum(F.col("blocks") * F.col("c")), F.lit(0))).first()[0]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), dealt // 4096)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, x, y, key = (batch.column(c).to_pylist() for c in (0, 1, 2, 5))
            for row in range(batch.num_rows):
                one, other = (Block(batch.column(c)[row].values) for c in (3, 4))
                yield from task(t[row], key[row], one, other, x[row] == y[row])

    return both.repartition(parts, "t", "key", "x", "y").mapInArrow(run, schema)


def across(docs: DataFrame, sets: DataFrame, open_rows: DataFrame) -> DataFrame:
    """a, b: links between the classes of each bucket (rows t, key, s, n, label), thinned to stars."""
    columns = ["s", "label", "n", "mins", "keys"]

    def likely(t: int, key: int, one: Block, other: Block, same: bool) -> Iterator[pa.RecordBatch]:
        pairs = list(likely_pairs(t, one, other, same))
        if pairs:
            s = np.unique(np.concatenate([one.s[[i for i, _ in pairs]], *[other.s[j] for _, j in pairs]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), t, np.int32)), pa.array(np.full(len(s), key)), pa.array(s)], ["t", "key", "s"])

    def links(t: int, key: int, one: Block, other: Block, same: bool) -> Iterator[pa.RecordBatch]:
        i, j = similar_pairs(t, one, other, same)
        if len(i):
            used, at = np.unique(np.concatenate([one.s[i], other.s[j]]), return_inverse=True)
            label = S.stars(len(used), at[: len(i)], at[len(i) :])
            new = label != np.arange(len(used))
            yield pa.RecordBatch.from_arrays([pa.array(used[label[new]]), pa.array(used[new])], ["a", "b"])

    rows = open_rows.join(sets.select("s", "mins", "keys"), "s")
    near = written(in_blocks(rows, columns, "open", likely, "t int, key long, s long").distinct(), "likely")
    held = written(sets_of(docs, sets, near.select("s").distinct()), "likely-sets")
    rows = rows.join(near, ["t", "key", "s"], "left_semi").join(held, "s")
    return in_blocks(rows, [*columns, "hashes"], "likely", links, "a long, b long")


def checked(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, of distinct sets) whose whole sets have a similarity of at least 4/5."""
    pairs = written(pairs, "candidates")
    held = written(sets_of(docs, sets, pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct()), "sets")
    both = pairs.join(held.select(F.col("s").alias("a"), F.col("hashes").alias("x")), "a").join(held.select(F.col("s").alias("b"), F.col("hashes").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    return written(both.filter(similar(common, F.size("x").cast("long"), F.size("y").cast("long"))).select("a", "b"), "similar")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(one row a row of docs, one a set with its first row, the class of each set that is not its class's smallest)."""
    prints = written(with_sketches(docs), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    sets = written(prints.groupBy("s").agg(F.min(first).alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("mins").alias("mins")), "sets")
    rows = sets.select("s", "n", F.posexplode("keys").alias("t", "key"))
    heads = rows.groupBy("t", "key").agg(F.min(F.struct(F.xxhash64("s", "t", "key").alias("o"), "s", "n")).alias("head"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    buckets = written(rows.join(heads.select("t", "key", "head"), ["t", "key"]), "buckets")
    agree = agreeing(F.col("mins_a"), F.col("mins_b"))
    fits = lambda n, m: 5 * F.least(n, m) >= 4 * F.greatest(n, m)

    met = buckets.filter(F.col("s") != F.col("head.s")).filter(fits(F.col("n"), F.col("head.n")))
    met = met.select(F.least("s", "head.s").alias("a"), F.greatest("s", "head.s").alias("b")).distinct()
    for side in ("a", "b"):
        met = met.join(sets.select(F.col("s").alias(side), F.col("mins").alias(f"mins_{side}")), side)
    met = met.filter(agree >= AGREE).select("a", "b").unionByName(fingerprint_links(prints)).distinct()
    edges = checked(docs, sets, met)
    label = written(components(edges), "labels")

    open_rows = buckets.join(label.withColumnRenamed("v", "s"), "s", "left").select("t", "key", "s", "n", F.coalesce("label", "s").alias("label"))
    open_rows = written(open_rows, "open")
    several = open_rows.groupBy("t", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("t", "key")
    open_rows = written(open_rows.join(several, ["t", "key"], "left_semi"), "several")
    more = written(across(docs, sets, open_rows), "across")
    if more.isEmpty():
        return prints, sets, label
    return prints, sets, written(components(edges.unionByName(more)), "labels")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs for each class of near copies."""
    prints, sets, label = _classes(docs)
    named = sets.select("s", "least").join(label, sets["s"] == label["v"], "left").select("least", F.coalesce("label", "s").alias("label"))
    kept = written(named.groupBy("label").agg(F.min("least").alias("kept")).select(F.col("kept.rid").alias("kept_rid")), "kept")
    # single rows that stay are not moved; the others meet the keys of what stays
    times = prints.groupBy("rid").agg(F.count(F.lit(1)).alias("c"))
    odd = written(times.join(kept, F.col("rid") == F.col("kept_rid"), "left").filter("c > 1 or kept_rid is null").select("rid"), "odd-rows")
    rows = marked(docs.select(F.xxhash64("doc_id", "text").alias("rid"), F.struct(*docs.columns).alias("row")), odd)
    some = rows.filter("hit").join(kept, F.col("rid") == F.col("kept_rid"), "left_semi").select("rid", F.col("row.doc_id").alias("doc"), F.col("row.text").alias("text"), "row")
    return rows.filter("not hit").select("row.*").unionByName(some.dropDuplicates(["rid", "doc", "text"]).select("row.*"))
