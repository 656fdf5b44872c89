"""Alignment of two tokenizers over a corpus (operator 12).

Side A is a byte-level BPE, side B a SentencePiece model. Both cut the same bytes (a space and the text). A batch of documents
becomes two frames of tokens by document and start; pandas merge_asof, keyed by document, finds for each token's start the
token of the other side that covers it. Two tokens overlap if the start of one lies in the other, so the union of both
directions has every overlap. Places where tokens of both sides end cut a document into groups; no overlap crosses them, so a
long document is aligned stretch by stretch, cut there.

A pair of ids is known by one number. Each document's different pairs and how often it has them are written once, counted by
document over the corpus (inside tasks first), and looked up again: the pairs of most documents, up to `common` of them, go to
all tasks as a table of bounded size; the others meet their counts in a join, and none of those is frequent. The tables of
the tokenizers go along as broadcasts, so executors need no files.

Defined results: null and empty texts, and those whose tokens don't spell a space and the text on either side, have no tokens:
zeros and an empty digest; repeated rows count as documents of their own; null doc_ids are kept; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm import arrays as A
from locusframe.llm.pieces import Pieces
from locusframe.llm.store import written

#: Bytes of text that are aligned at a time, and tokens of one long text.
CHUNK = 1 << 20
STRETCH = 1 << 19
#: Pairs whose counts go to all tasks.
COMMON = 1 << 18
#: Different pairs that a task counts before it hands them on.
HELD = 1 << 21


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it is printable, else the next from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


@dataclass(frozen=True)
class Tokenizers:
    byte_level: str  # the JSON of side A
    pattern: str  # what it cuts text into first
    model: bytes  # the model of side B
    raw_a: list[bytes]
    raw_b: list[bytes]

    @classmethod
    def load(cls, byte_level: str | None = None, pieces: str | None = None) -> Tokenizers:
        """From a byte-level BPE's JSON and a SentencePiece model; by default the public ones installed with the tokenizers."""
        import public_tokenizers

        path_a, path_b = byte_level or public_tokenizers.path("byte_bpe_50k.json"), pieces or public_tokenizers.path("piece_bpe_32k.model")
        with open(path_a, encoding="utf-8") as f:
            text = f.read()
        with open(path_b, "rb") as f:
            model = f.read()
        found, letters = json.loads(text), byte_letters()
        special = {t["id"] for t in found["added_tokens"]}
        vocabulary = found["model"]["vocab"]
        raw_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            raw_a[i] = b"" if i in special else bytes(letters[c] for c in token)
        return cls(text, public_tokenizers.PATTERN, model, raw_a, Pieces.load(path_b).raw())

    def encoders(self) -> Encoders:
        return Encoders(self)


class Encoders:
    """Both libraries' encoders inside a task."""

    def __init__(self, of: Tokenizers):
        import sentencepiece
        import tiktoken

        self.of, self.slow = of, None
        # ids are merge ranks; the faster library gives the same ids (tests compare it)
        ranks = {raw: i for i, raw in enumerate(of.raw_a) if raw}
        self.fast = tiktoken.Encoding("a", pat_str=of.pattern, mergeable_ranks=ranks, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_proto=of.model)
        self.length_a, self.length_b = (np.array([len(x) for x in raw], np.int64) for raw in (of.raw_a, of.raw_b))
        # a token's number, and what stands after it within its group and at the end of its side
        names = [[str(i) + end for i in range(len(raw)) for end in ends] for raw, ends in ((of.raw_a, ",|"), (of.raw_b, ",;"))]
        self.names, self.base = names[0] + names[1], len(names[0])

    def a(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:  # its pattern gives up on very long runs of spaces
            if self.slow is None:
                import tokenizers

                self.slow = tokenizers.Tokenizer.from_str(self.of.byte_level)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)

    def both(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text on both sides; none where a side does not spell a space and the text."""
        of, none = self.of, np.zeros(0, np.int64)
        a, b = [], []
        spelled = self.model.encode([t or "" for t in texts], num_threads=1)
        for text, y in zip(texts, spelled, strict=True):
            whole = " " + (text or "")
            want = whole.encode()
            same = bool(text) and b"".join(map(of.raw_b.__getitem__, y)) == want
            x = self.a(whole) if same else none
            same = same and b"".join(map(of.raw_a.__getitem__, x.tolist())) == want
            a.append(x if same else none)
            b.append(np.array(y, np.int64) if same else none)
        return a, b


def groups(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(last of its group, group) of the tokens of A, then of B; ends are those of tokens that cover the same bytes."""
    ends = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.uint8)
    ends[end_a] |= 1
    ends[end_b] |= 2
    last_a, last_b = ends[end_a] == 3, ends[end_b] == 3
    return last_a, np.cumsum(last_a) - last_a, last_b, np.cumsum(last_b) - last_b


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of overlapping tokens in A and in B. Starts count over the batch, so they are in order; documents key the match."""
    one = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(start_a))})
    two = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(start_b))})
    over_a = pd.merge_asof(one, two, on="start", by="doc")
    over_b = pd.merge_asof(two, one, on="start", by="doc")
    # tokens that start together are found both ways
    later = over_b["start"].to_numpy() > start_a[over_b["a"].to_numpy()]
    return np.concatenate([over_a["a"].to_numpy(), over_b["a"].to_numpy()[later]]), np.concatenate([over_a["b"].to_numpy(), over_b["b"].to_numpy()[later]])


def summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of n (1 if not given) of each."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys))) if n is None else np.add.reduceat(n, first)


def _digest(names: list[str], order: np.ndarray) -> str:
    sha = hashlib.sha256()
    for at in range(0, len(order), STRETCH):
        part = "".join(map(names.__getitem__, order[at : at + STRETCH].tolist()))
        sha.update((part if at + STRETCH < len(order) else part[:-1]).encode())
    return sha.hexdigest() if len(order) else ""


def aligned(enc: Encoders, texts: list[str | None], pairs_b: int) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """([n_a, n_b, n_groups, n_links] by document, digests, documents of pairs, pairs, how often) of a few texts."""
    ids_a, ids_b = enc.both(texts)
    n = len(texts)
    size_a, size_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
    a, b = np.concatenate(ids_a), np.concatenate(ids_b)
    doc_a, doc_b = np.repeat(np.arange(n), size_a), np.repeat(np.arange(n), size_b)
    end_a, end_b = np.cumsum(enc.length_a[a]), np.cumsum(enc.length_b[b])
    start_a, start_b = end_a - enc.length_a[a], end_b - enc.length_b[b]
    last_a, group_a, last_b, group_b = groups(end_a, end_b)
    n_groups = np.bincount(doc_a[last_a], minlength=n)
    # the tokens as they are written: of each group those of A, then those of B
    count = int(last_a.sum())
    of_a, of_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + (np.cumsum(of_b) - of_b)[group_a]] = a * 2 + last_a
    order[np.arange(len(b)) + np.cumsum(of_a)[group_b]] = enc.base + b * 2 + last_b
    edge = np.concatenate([[0], np.cumsum(size_a + size_b)])
    digests = [_digest(enc.names, order[edge[i] : edge[i + 1]]) for i in range(n)]
    n_links, held = np.zeros(n, np.int64), []
    # cuts after whole groups, each stretch of about STRETCH tokens
    total = np.cumsum(of_a + of_b)
    cuts = np.unique(np.append(np.searchsorted(total, np.arange(STRETCH, int(total[-1]) if count else 0, STRETCH)), count))
    lo_a = lo_b = 0
    for cut in cuts[cuts > 0] if count else []:
        hi_a, hi_b = int(np.searchsorted(group_a, cut)), int(np.searchsorted(group_b, cut))
        x, y = overlaps(doc_a[lo_a:hi_a], start_a[lo_a:hi_a], doc_b[lo_b:hi_b], start_b[lo_b:hi_b])
        doc = doc_a[lo_a:hi_a][x]
        n_links += np.bincount(doc, minlength=n)
        # documents of a chunk are few: they go above the 40 bits of a pair
        held.append(summed(doc << 40 | a[lo_a:hi_a][x] * pairs_b + b[lo_b:hi_b][y]))
        lo_a, lo_b = hi_a, hi_b
    keys, often = held[0] if len(held) == 1 else summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return [size_a, size_b, n_groups, n_links], digests, keys >> 40, keys & ((1 << 40) - 1), often


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A row of bytes for each count: its values."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, values of each row) of _binary."""
    data, offsets = A.text_bytes(column)
    return data[offsets[0] : offsets[-1]].view(kind), np.diff(offsets) // np.dtype(kind).itemsize


def _kind(tokenizers: Tokenizers) -> str:
    """How pairs are held."""
    most = len(tokenizers.raw_a) * len(tokenizers.raw_b)
    if most > 1 << 40:
        raise ValueError("the two vocabularies have too many pairs of ids")
    return "<u4" if most <= 1 << 32 else "<u8"


_STATS = ("n_a", "n_b", "n_groups", "n_links")


def links(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """rid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and often (bytes): every row's tokens, aligned."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)
    kind, n_b = _kind(tokenizers), len(tokenizers.raw_b)
    names = ["rid", "doc_id", *_STATS, "groups_sha256", "pairs", "often"]
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared.value.encoders()
        for batch in batches:
            for lo, hi, _, _ in A.chunks(batch.column(2), CHUNK):
                part = batch.slice(lo, hi - lo)
                stats, digests, doc, pairs, often = aligned(enc, part.column(2).to_pylist(), n_b)
                per = np.bincount(doc, minlength=hi - lo)
                made = [*(pa.array(x.astype(np.int64)) for x in stats), pa.array(digests), _binary(pairs.astype(kind), per), _binary(often.astype("<u4"), per)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(task, f"rid long, doc_id {id_type}, {', '.join(f'{c} long' for c in _STATS)}, groups_sha256 string, pairs binary, often binary")


def pair_counts(held: DataFrame, kind: str) -> DataFrame:
    """pair, n: the documents that have each pair."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def fold():
            new, times = summed(np.concatenate(waiting))
            return summed(np.concatenate([keys, new]), np.concatenate([n, times]))

        for batch in batches:
            values, _ = _numbers(batch.column(0), kind)
            waiting.append(values.astype(np.int64))
            size += len(values)
            if size > HELD:
                keys, n = fold()
                waiting, size = [], 0
                if len(keys) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])
                    keys, n = keys[:0], n[:0]
        if waiting:
            keys, n = fold()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

    return held.select("pairs").mapInArrow(task, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> int:
    """The least count of which no more than `most` pairs are; the driver sees a number for each class of counts."""
    total, least = 0, None
    for r in sorted(counts.groupBy(F.floor(F.log2("n") * 16).alias("of")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")).collect(), reverse=True):
        total += r.pairs
        if total > most:
            break
        least = r.least
    return least if least is not None else 1 << 62


def align(docs: DataFrame, tokenizers: Tokenizers, common: int = COMMON) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links of a pair that as many documents have as any pair of its A id),
    count_sum (over links, the documents that have the pair), groups_sha256, for every row of docs."""
    kind, n_b = _kind(tokenizers), len(tokenizers.raw_b)
    held = written(links(docs, tokenizers), "token-links")
    counts = written(pair_counts(held, kind), "token-pairs")
    # one row an id of A at most
    tops = counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("n").alias("top"))
    known = counts.join(F.broadcast(tops), F.floor(F.col("pair") / n_b) == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    least = _frequent(counts, common)
    table = known.filter(F.col("n") >= least).toPandas().sort_values("pair")
    shared = docs.sparkSession.sparkContext.broadcast([table[c].to_numpy() for c in ("pair", "n", "best")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            pairs, sizes = _numbers(batch.column(1), kind)
            often = _numbers(batch.column(2), "<u4")[0].astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            rid = batch.column(0).to_numpy()
            for lo in range(0, len(rid), 256):
                hi = min(lo + 256, len(rid))
                own = slice(edges[lo], edges[hi])
                p, times = pairs[own].astype(np.int64), often[own]
                doc = np.repeat(np.arange(hi - lo), sizes[lo:hi])
                at = np.searchsorted(keys, p)
                hit = at < len(keys)
                hit[hit] = keys[at[hit]] == p[hit]
                at = at[hit]
                sums, bests = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
                np.add.at(sums, doc[hit], times[hit] * n[at])
                np.add.at(bests, doc[hit], times[hit] * best[at])
                rest = ~hit
                # a document's sums so far go under a key of its own, below all pairs
                columns = [np.concatenate(x) for x in ((-1 - rid[lo:hi], p[rest]), (rid[lo:hi], rid[lo:hi][doc[rest]]), (bests, times[rest]), (sums, times[rest]))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "rid", "best_links", "total"])

    looked = held.select("rid", "pairs", "often").mapInArrow(task, "key long, rid long, best_links long, total long")
    rare = known.filter(F.col("n") < least)
    met = looked.join(rare, looked["key"] == rare["pair"], "left")
    found = F.col("pair").isNotNull()
    sums = met.groupBy("rid").agg(
        F.sum(F.when(found, F.when(F.col("best"), F.col("best_links")).otherwise(0)).otherwise(F.col("best_links"))).alias("n_best"),
        F.sum(F.when(found, F.col("total") * F.col("n")).otherwise(F.col("total"))).alias("count_sum"),
    )
    return held.select("rid", "doc_id", *_STATS, "groups_sha256").join(sums, "rid", "left").select("doc_id", *_STATS, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
