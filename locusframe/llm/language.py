"""Language identification (operator 5): averaged hashed subword embeddings and a linear softmax, trained with numpy.

ASCII letters and capitals of the Latin-1 block are lower-cased, bytes from 128 up stay as they are and all other bytes become
spaces; a text's subwords are the byte n-grams of that, each hashed to one of `buckets` embeddings. A text is the mean of its
subwords' embeddings, and a linear softmax on the mean gives the languages. Training is stochastic gradient descent on a
bounded sample of labelled texts of every language, chosen by a hash: about `per_language` of each, fewer if the languages
together would have more than `examples`, and at least one. Tasks count their subwords, so the driver gets no text; of a
language's texts those are taken, in the hash's order, that begin within its share of `entries` different subwords (a text has
`buckets` of them at most). As mean and softmax are linear before the exponential, scoring adds up, for each subword, one row
of (embeddings x weights) or, with more languages than an embedding has numbers, one embedding; whole texts at a time.

A part of the sample is set aside to fit the temperature that calibrates the probabilities, and the score below which a
prediction is rejected: the smallest that leaves `precision` of the accepted ones right.

Defined results: a null text, or one without a letter, is `und` with score 0, as is every text if nothing can be learned;
ties go to the language first in code point order; labels that are null are not learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm import arrays as A

UNKNOWN = "und"
SIZES = (2, 3, 4)
_U = np.uint64


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # numbers x buckets: embedding times weights, or the embedding
    weight: np.ndarray  # numbers x languages: one, or the weights
    bias: np.ndarray
    temperature: float
    reject_below: float


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Bytes: lower case (ASCII) or as they are beyond it, other ASCII a space; and which may be part of a letter."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    keep = np.zeros(256, bool)
    keep[97:123] = keep[65:91] = True
    keep[128:] = True
    low[~keep] = 32
    return low, keep


_LOW, _KEEP = _letters()


def has_letter(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.match_substring_regex(pc.fill_null(column.cast(pa.large_string()), ""), r"\p{L}").to_numpy(zero_copy_only=False)


def subwords(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every subword."""
    text = _LOW[data].astype(_U)
    # capital letters of two bytes, Latin-1 block: C3 80..9E become C3 A0..BE
    if len(data) > 1:
        upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        text[upper] += _U(0x20)
    n = len(text)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    code = text.copy()
    found, rows = [], []
    for size in range(2, max(SIZES) + 1):
        if n < size:
            break
        code = (code[:-1] << _U(8)) | text[size - 1 :]
        if size in SIZES:
            fits = np.flatnonzero((row[: n - size + 1] == row[size - 1 :]) & (code != _U(int("20" * size, 16))))
            found.append((A.mix(code[fits] + _U(size << 40)) % _U(buckets)).astype(np.int64))
            rows.append(row[fits])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found), np.concatenate(rows)) if found else (none, none)


def logits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    bucket, row = subwords(data, offsets, model.table.shape[1])
    n = len(offsets) - 1
    total = np.maximum(np.bincount(row, minlength=n), 1)
    return np.stack([np.bincount(row, line[bucket], minlength=n) / total for line in model.table], 1) @ model.weight + model.bias


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def counted(texts: list[str], buckets: int = 1 << 15) -> list[tuple[np.ndarray, np.ndarray]]:
    """(different buckets, their counts) of each text's subwords."""
    out = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        out.append(np.unique(subwords(data, np.array([0, len(data)]), buckets)[0], return_counts=True))
    return out


def train(counts: list[tuple[np.ndarray, np.ndarray]], labels: list[str], buckets: int = 1 << 15, width: int = 16, epochs: int = 8, rate: float = 0.5, precision: float = 0.95, seed: int = 7) -> Model | None:
    languages = sorted(set(labels), key=lambda x: x.encode())
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    y = np.searchsorted(np.array([x.encode() for x in languages], object), [x.encode() for x in labels])
    docs = [(used, count / max(count.sum(), 1)) for used, count in counts]
    order = rng.permutation(len(docs))
    aside, learn = order[: len(order) // 5], order[len(order) // 5 :]
    if len(learn) == 0:
        aside, learn = order, order
    embed = rng.normal(0, 0.1, (buckets, width))
    weight, bias = np.zeros((width, len(languages))), np.zeros(len(languages))
    steps, k = epochs * len(learn), 0
    for _ in range(epochs):
        for i in rng.permutation(learn):
            used, share = docs[i]
            step = rate * (1 - k / steps)
            k += 1
            mean = share @ embed[used]
            z = mean @ weight + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = weight @ p
            weight -= step * np.outer(mean, p)
            bias -= step * 0.1 * p
            # a row's step is scaled by the number of rows, as each has but a small share of the mean
            embed[used] -= step * np.minimum(share * len(used), 10)[:, None] * back
    few = len(languages) <= width
    table, weight = (np.ascontiguousarray((embed @ weight).T), np.eye(len(languages))) if few else (np.ascontiguousarray(embed.T), weight)
    held = aside if len(aside) else learn
    z = np.array([share @ table.T[used] for used, share in (docs[i] for i in held)]).reshape(len(held), -1) @ weight + bias
    best = min((2.0**e for e in np.arange(-5, 5.01, 0.25)), key=lambda t: -np.log(np.maximum(softmax(z / t)[np.arange(len(held)), y[held]], 1e-12)).mean())
    p = softmax(z / best)
    top, right = p.max(1), p.argmax(1) == y[held]
    order = np.argsort(-top, kind="stable")
    good = np.flatnonzero(np.cumsum(right[order]) >= precision * np.arange(1, len(order) + 1))
    return Model(languages, table, weight, bias, best, float(top[order[good[-1]]]) if len(good) else 1.0)


def sample(docs: DataFrame, per_language: int, examples: int) -> tuple[DataFrame, int]:
    """(text, lang, point: rows chosen by a hash of the text and its id, at least one of each language; how many languages)."""
    # a hash in [0, 1); no text moves before it is chosen
    point = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.filter("text is not null and lang is not null").select("text", "lang", point.alias("point"))
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("point").alias("least")).collect()
    each = min(per_language, examples / max(len(known), 1))
    shares = docs.sparkSession.createDataFrame([(r.lang, max(each / r.n, r.least)) for r in known], "of string, share double")
    shares = F.broadcast(shares) if len(known) <= 10_000 else shares
    chosen = rows.join(shares, F.col("lang") == F.col("of")).filter("point <= share")
    # repeated rows share a point: one text of them
    return chosen.groupBy("lang", "point").agg(F.min("text").alias("text")).select("text", "lang", "point"), len(known)


def learn(docs: DataFrame, per_language: int = 400, examples: int = 20_000, entries: int = 1 << 23, buckets: int = 1 << 15, **options) -> Model | None:
    """A model from the labelled rows of docs (columns doc_id, text, lang)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                used, count = counted([batch.column(0)[i].as_py()], buckets)[0]
                columns = [batch.column(1).slice(i, 1), batch.column(2).slice(i, 1), pa.array([used.astype(np.int32)]), pa.array([count.astype(np.int64)])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "point", "used", "count"])

    chosen, languages = sample(docs, per_language, examples)
    if not languages:
        return None
    order = Window.partitionBy("lang").orderBy("point", F.xxhash64("used", "count"))
    before = F.sum(F.size("used")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.size("used")
    rows = chosen.mapInArrow(task, "lang string, point double, used array<int>, count array<long>").withColumn("before", before)
    rows = rows.filter(F.col("before") < entries // languages).toArrow().sort_by([("point", "ascending"), ("lang", "ascending"), ("before", "ascending")])
    flat = [[np.asarray(x.values) for x in rows.column(name)] for name in ("used", "count")]
    return train(list(zip(*flat, strict=True)), rows.column("lang").to_pylist(), buckets, **options)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*(model.languages if model else []), UNKNOWN], object)
        for batch in batches:
            lettered = has_letter(batch.column(1))
            for at, end, data, offsets in A.chunks(batch.column(1)):
                best, score = np.full(end - at, len(names) - 1), np.zeros(end - at)
                if model:
                    p = softmax(logits(model, data, offsets) / model.temperature)
                    known = lettered[at:end]
                    best[known], score[known] = p.argmax(1)[known], p.max(1)[known]
                accepted = (best < len(names) - 1) & (score >= (model.reject_below if model else 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(names[best], pa.string()), pa.array(score), pa.array(accepted)], ["doc_id", "lang_pred", "score", "accepted"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, lang_pred string, score double, accepted boolean")


def held_out(docs: DataFrame):
    """True for a quarter of the rows, by doc_id; a null doc_id is not held out."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, per_language: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted; learned from the rows that are not held out."""
    model = learn(docs.filter(~held_out(docs)).select("doc_id", "text", "lang"), per_language)
    out = predict(docs, model)
    return out.withColumn("held_out", held_out(out))
