"""SentencePiece encoding and decoding (operator 7) with a published piece table; nothing is trained.

The relational lattice: each word's substrings up to the longest piece are exploded, equi-joined to the piece table and grouped
by word as the lattice's edges; a higher-order aggregate folds the edges to the word's pieces. The model at hand is byte-pair
encoding: its scores are merge ranks, for which the best path of a Viterbi search is not the encoding. So the fold merges, of
the edges that span two neighbouring segments, the one of the best score until none is left.

Words are cut before a run of spaces and around \\t and \\n, which no piece of such models spans (checked on loading). The join
serves the corpus's frequent words, at most `dictionary` of them and of LONGEST_WORD characters each, so that the encodings go
to all tasks as a table of bounded size; which words are in it changes no result. A join of all words' encodings back to each
text would shuffle every token twice, more than twice the input. Words outside the table are merged in the task that meets
them, by the same rule.

As the library does, a text gets a space before it, spaces become U+2581, and characters without a piece become their UTF-8
bytes' pieces. Defined results: null and empty texts have no pieces; U+2581 in a text decodes to a space, so such a text does
not come back as it was; repeated rows are encoded alike.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.store import written

SPACE = "▁"
UNIT = f"{SPACE}+[^{SPACE}\\t\\n]*|[^{SPACE}\\t\\n]+|[\\t\\n]"
LONGEST_WORD = 64
#: Words that a task remembers besides the table.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Pieces:
    names: list[str]
    scores: list[float]
    byte_ids: list[int]  # of <0x00> .. <0xFF>
    plain: frozenset[int]  # pieces that are text

    @classmethod
    def load(cls, path: str | None = None) -> Pieces:
        """From a SentencePiece model file; by default the public one installed with the tokenizers."""
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = frozenset(i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
        if any(SPACE in names[i].lstrip(SPACE) or re.search("[\t\n]", names[i]) for i in plain):
            raise ValueError("pieces that span words are not supported")
        return cls(names, [sp.get_score(i) for i in range(n)], [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], plain)

    def table(self) -> dict[str, tuple[float, int]]:
        return {self.names[i]: (self.scores[i], i) for i in self.plain}

    def raw(self) -> list[bytes]:
        """The bytes that each piece decodes to."""
        out = [self.names[i].replace(SPACE, " ").encode() if i in self.plain else b"" for i in range(len(self.names))]
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        return out


_NONE = (float("-inf"), -1)


def _merge_short(word: str, table: dict[str, tuple[float, int]], byte_ids: list[int]) -> list[int]:
    parts, get, none = list(word), table.get, _NONE[0]
    # the score of each segment with the next one
    pairs = [get(word[i : i + 2], _NONE)[0] for i in range(len(word) - 1)]
    while pairs:
        best = max(pairs)
        if best == none:
            break
        at = pairs.index(best)
        parts[at] += parts.pop(at + 1)
        del pairs[at]
        if at < len(pairs):
            pairs[at] = get(parts[at] + parts[at + 1], _NONE)[0]
        if at:
            pairs[at - 1] = get(parts[at - 1] + parts[at], _NONE)[0]
    ids: list[int] = []
    for part in parts:
        found = get(part)
        ids += [found[1]] if found else [byte_ids[b] for b in part.encode()]
    return ids


def merge(word: str, table: dict[str, tuple[float, int]], byte_ids: list[int]) -> list[int]:
    """The word's pieces: neighbours merge by the best score, the leftmost of equals."""
    n = len(word)
    if n <= 20:
        return _merge_short(word, table, byte_ids)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n and (found := table.get(word[i : end[end[i]]])):
            heapq.heappush(heap, (-found[0], i, end[end[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        # the segments that were to merge must still be as they were
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        gone = end[i]
        alive[gone] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        offer(before[i])
    ids, i = [], 0
    while i < n:
        found = table.get(word[i : end[i]])
        ids += [found[1]] if found else [byte_ids[b] for b in word[i : end[i]].encode()]
        i = end[i]
    return ids


def edges(words: DataFrame, pieces: Pieces) -> DataFrame:
    """word, edges: a map from (start * 1024 + length) to (score, id) of the pieces that stand in each word of column `word`."""
    spark = words.sparkSession
    rows = [(pieces.names[i], i, pieces.scores[i]) for i in sorted(pieces.plain)]
    table = spark.createDataFrame(rows, "piece string, id int, score double")
    longest = max(len(pieces.names[i]) for i in pieces.plain)
    n = F.char_length("word")
    starts = F.sequence(F.lit(0), n - 1)
    parts = F.flatten(F.transform(starts, lambda s: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), n - s)), lambda k: F.struct(s.alias("start"), k.alias("len")))))
    subs = words.select("word", F.explode(parts).alias("e")).select("word", "e.start", "e.len", F.substring("word", F.col("e.start") + 1, F.col("e.len")).alias("piece"))
    # the piece table has a fixed size
    found = subs.join(F.broadcast(table), "piece", "left")
    edge = F.when(F.col("id").isNotNull(), F.struct((F.col("start") * 1024 + F.col("len")).alias("key"), F.struct("score", "id").alias("value")))
    return found.groupBy("word").agg(F.map_from_entries(F.collect_list(edge)).alias("edges"))


def fold(word: Column, edges: Column, pieces: Pieces) -> Column:
    """array<int>: the word's pieces, from its edges."""
    n = F.char_length(word)
    place = lambda start, size: start * 1024 + size
    alone = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("start"), F.lit(1).alias("len")))

    def step(acc: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))), lambda i: F.struct(F.try_element_at(edges, place(F.element_at(acc, i)["start"], F.element_at(acc, i)["len"] + F.coalesce(F.try_element_at(acc, i + 1)["len"], F.lit(0))))["score"].alias("score"), (-i).alias("at")))
        best = F.array_max(F.filter(pairs, lambda p: p["score"].isNotNull()))
        at = -best["at"]
        joined = F.struct(F.element_at(acc, at)["start"].alias("start"), (F.element_at(acc, at)["len"] + F.element_at(acc, at + 1)["len"]).alias("len"))
        return F.when((F.size(acc) < 2) | best.isNull(), acc).otherwise(F.concat(F.slice(acc, F.lit(1), at - 1), F.array(joined), F.slice(acc, at + 2, F.size(acc))))

    def ids(segments: Column) -> Column:
        bytes_of = F.array(*[F.lit(i) for i in pieces.byte_ids])

        def one(s: Column) -> Column:
            raw = F.hex(F.encode(F.substring(word, s["start"] + 1, s["len"]), "UTF-8"))
            spelled = F.transform(F.sequence(F.lit(1), F.length(raw), F.lit(2)), lambda k: F.element_at(bytes_of, F.conv(F.substring(raw, k, F.lit(2)), 16, 10).cast("int") + 1))
            known = F.try_element_at(edges, place(s["start"], s["len"]))["id"]
            return F.when(known.isNotNull(), F.array(known)).otherwise(spelled)

        return F.flatten(F.transform(segments, one))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), alone, step, ids)


def encode_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """word, ids of different words (column `word`, not empty, at most 512 characters)."""
    return edges(words, pieces).select("word", fold(F.col("word"), F.col("edges"), pieces).alias("ids"))


def normalised(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit(SPACE), F.translate(text, " ", SPACE)))


def frequent_words(docs: DataFrame, most: int) -> DataFrame:
    """word: the most frequent words of all texts that occur twice and are not too long, at most so many.

    Counts fall into classes of about 4 % each; the words of the highest classes that fit are taken, so nothing is sorted and
    the driver sees a number for each class.
    """
    words = docs.select(F.explode(F.regexp_extract_all(normalised(docs["text"]), F.lit(UNIT), F.lit(0))).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & (F.char_length("word") <= LONGEST_WORD))
    counts = written(counts.select("word", F.floor(F.log2("n") * 16).cast("int").alias("of")), "frequent-words")
    least, total = None, 0
    for r in sorted(counts.groupBy("of").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        total += r.words
        if total > most:
            break
        least = r.of
    return counts.filter(F.lit(False) if least is None else F.col("of") >= least).select("word").repartition("word")


class Memory(dict):
    """Encodings by word, as bytes of 32-bit numbers; what is not there is merged and remembered for a while."""

    def __init__(self, table, pieces):
        super().__init__(table)
        self.fixed, self.pieces, self.byte_ids = table, pieces.table(), pieces.byte_ids

    def __missing__(self, word: str) -> bytes:
        out = np.array(merge(word, self.pieces, self.byte_ids), "<i4").tobytes()
        if len(word) <= 256:
            self[word] = out
        return out

    def trim(self) -> None:
        if len(self) > len(self.fixed) + REMEMBERED:
            self.clear()
            self.update(self.fixed)


def _encoded(docs: DataFrame, pieces: Pieces, dictionary: int):
    """(broadcast word table, broadcast pieces)."""
    context = docs.sparkSession.sparkContext
    table = {r.word: np.array(r.ids, "<i4").tobytes() for r in encode_words(frequent_words(docs, dictionary), pieces).toLocalIterator()} if dictionary else {}
    return context.broadcast(table), context.broadcast(pieces)


def encode(docs: DataFrame, pieces: Pieces, dictionary: int = 1 << 16, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The named columns of docs and ids (array<int>)."""
    return _over(docs, pieces, dictionary, columns, digest=False)


def digests(docs: DataFrame, pieces: Pieces, dictionary: int = 1 << 16) -> DataFrame:
    """doc_id, n_tokens, n_bytes (of them byte pieces), ids_sha256 (ids as little-endian 32-bit), round_trip: decoding the ids
    gives the text."""
    return _over(docs, pieces, dictionary, ("doc_id",), digest=True)


def _over(docs: DataFrame, pieces: Pieces, dictionary: int, columns: tuple[str, ...], digest: bool) -> DataFrame:
    table, shared = _encoded(docs, pieces, dictionary)
    own = docs.select(*columns).schema
    made = "n_tokens long, n_bytes long, ids_sha256 string, round_trip boolean" if digest else "ids array<int>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.fields), made])
    names = [*columns, *(x.split()[0] for x in made.split(", "))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(table.value, shared.value)
        unit = re.compile(UNIT)
        raw = shared.value.raw()
        spelled = np.zeros(len(raw), bool)
        spelled[shared.value.byte_ids] = True
        step = 256
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = []
                for text in part.column(0).to_pylist():
                    ids.append(b"".join(map(memory.__getitem__, unit.findall(SPACE + text.replace(" ", SPACE)))) if text else b"")
                memory.trim()
                if digest:
                    arrays = [np.frombuffer(x, "<i4") for x in ids]
                    same = [decode_ids(a, raw) == (t or "").encode() for a, t in zip(arrays, part.column(0).to_pylist(), strict=True)]
                    out = [pa.array([len(a) for a in arrays], pa.int64()), pa.array([int(spelled[a].sum()) for a in arrays], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array(same)]
                else:
                    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                    out = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *out], names)

    return docs.select(docs["text"].alias("text"), *[docs[c].alias(f"own{i}") for i, c in enumerate(columns)]).mapInArrow(task, schema)


def decode_ids(ids: np.ndarray, raw: list[bytes]) -> bytes:
    """The bytes of a text's pieces, without the space before it."""
    out = b"".join(map(raw.__getitem__, ids.tolist()))
    return out[1:] if out[:1] == b" " else out


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """encoded (with a column ids) with text instead of ids; null ids give the empty text."""
    rest = [c for c in encoded.columns if c != "ids"]
    shared = encoded.sparkSession.sparkContext.broadcast(pieces)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*rest).schema.fields), "text string"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shared.value.raw()
        for batch in batches:
            texts = [decode_ids(np.array(x or [], int), raw).decode("utf-8", "replace") for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*rest, "text"])

    return encoded.select("ids", *rest).mapInArrow(task, schema)
