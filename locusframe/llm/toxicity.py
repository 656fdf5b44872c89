"""Toxicity by nearest labelled examples (operator 2): a weighted TF-IDF cosine over a block-max inverted index.

The search is exact for that cosine, which is not the plain one: words that go with no label weigh less, and a query's length
counts the words of the index alone.

The examples are a bounded sample: about `per_label` labelled rows of either label, chosen by a hash; each label's rows stand
for all its labelled rows. The vocabulary is every lower-case word of the examples, and of the words' prefixes of PREFIXES
letters and of the marks "found 2, 3, 5 times" those that go with one label. A term weighs
(1 + log tf) log((n + 1) / (df + 0.5)), df counted over all documents; terms that go with one label (a likelihood-ratio test
on the examples) weigh in full, the others by OTHERS of it, as a cosine over all words alike sees mostly topic.

The inverted index holds, for each term, the blocks of BLOCK examples that have it, with the largest weight in the block, and
for each such block the examples and weights. Terms that a share of DENSE of the examples have stand as rows of a table
instead. Examples are numbered so that those with common terms share blocks, so a term stands in fewer blocks and bounds are
closer. A query adds up that table's rows, and to the largest sum in each block the largest weights of its other terms: a
bound. It opens blocks by falling bound, and stops when a bound is below its k-th cosine; so the k nearest are exact. Their votes, weighed by cosine and
by how many labelled rows each stands for, become a probability by a logistic fit to the examples' own leave-one-out votes.
The doc_ids of the examples that voted are the evidence. Different examples with the same vector are one example, under the
smallest doc_id, with their joint votes.

Defined results: null and empty texts, and texts without a word of the vocabulary, get the share of label 1 among the examples
like them; without examples of both labels every score is the share of label 1 (0 without labels); labels other than 0 and 1,
and null ones, are not learned; of several labels of one doc_id all count.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.store import written

WORD = re.compile(r"[^\W_]+")
PREFIXES = (3, 4, 5, 6)
#: A term found so often is a further term, "<term> x<times>": a cosine alone does not see how often all terms are there.
LEVELS = (2, 3, 5)
BLOCK = 32
#: Blocks that a query opens first; then four times as many each time.
STEP = 8
DENSE = 1 / 8
#: So many of the most frequent terms decide which examples share a block.
ALIKE = 512
#: The weight of terms that go with no label.
OTHERS = 0.05


def _forms(word: str) -> tuple[str, ...]:
    return (word, *[f"{word[:k]}*" for k in PREFIXES if len(word) > k])


def terms(text: str | None) -> Counter:
    """Counts of the text's words, their prefixes, and the marks of how often each was found."""
    found: Counter = Counter()
    for word, n in Counter(WORD.findall((text or "").lower())).items():
        for term in _forms(word):
            found[term] += n
    return found + Counter(f"{t} x{level}" for t, n in found.items() for level in LEVELS if n >= level)


class _Words(dict):
    """A number for each word met, and in `flat`, from first[number] to first[number + 1], the vocabulary's terms in it."""

    def __init__(self, wanted: dict[str, int]):
        super().__init__()
        self.wanted, self.flat, self.first = wanted, array("q"), array("q", [0])
        self.starts = {k: {t[:-1]: i for t, i in wanted.items() if len(t) == k + 1 and t[-1] == "*"} for k in PREFIXES}

    def __missing__(self, word: str) -> int:
        if word in self.wanted:
            self.flat.append(self.wanted[word])
        n = len(word)
        for k, starts in self.starts.items():
            if n > k and (hit := starts.get(word[:k])) is not None:
                self.flat.append(hit)
        self.first.append(len(self.flat))
        self[word] = len(self)
        return len(self) - 1


class Finder:
    """The vocabulary's terms in texts, by number. Remembers what is wanted of a word, so most words cost one look-up."""

    def __init__(self, wanted: dict[str, int]):
        self.wanted, self.known = wanted, _Words(wanted)
        marks = sorted((wanted[t.rpartition(" x")[0]], int(t.rpartition(" x")[2]), i) for t, i in wanted.items() if " x" in t)
        self.base, self.level, self.mark = np.array(marks, np.int64).reshape(-1, 3).T

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms in order, their counts)."""
        if len(self.known) > 300_000:
            self.known = _Words(self.wanted)
        words = WORD.findall((text or "").lower())
        number, n = np.unique(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)), return_counts=True)
        first = np.frombuffer(self.known.first, np.int64)
        lo, hi = first[number], first[number + 1]
        hits = np.frombuffer(self.known.flat, np.int64)[_ranges(lo, hi)] if len(self.known.flat) else number[:0]
        ids, place = np.unique(hits, return_inverse=True)
        counts = np.bincount(place, np.repeat(n, hi - lo), minlength=len(ids))
        if len(self.mark) and len(ids):
            at = np.minimum(np.searchsorted(ids, self.base), len(ids) - 1)
            more = self.mark[(ids[at] == self.base) & (counts[at] >= self.level)]
            ids, counts = np.append(ids, more), np.append(counts, np.ones(len(more)))
            order = np.argsort(ids)
            ids, counts = ids[order], counts[order]
        return ids, counts


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0] .. last[0] - 1, first[1] .. last[1] - 1, ..."""
    sizes = last - first
    return np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)


@dataclass
class Index:
    vocabulary: dict[str, int]
    idf: np.ndarray  # times OTHERS for terms that go with no label
    strong: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))  # terms that go with a label
    names: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # doc_id of each example
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))  # votes of each example for label 1
    clean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    entries: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # of each term: its first entry, and the end
    block: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # of each entry
    most: np.ndarray = field(default_factory=lambda: np.zeros(0))  # the largest weight of the term in that block
    postings: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # of each entry: its first posting, and the end
    example: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # of each posting
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    row: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # of each term: its row in the table, or -1
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    k: int = 15
    slope: float = 1.0
    shift: float = 0.0
    base: float = 0.0
    plain: float = 0.0

    def vector(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of length 1."""
        raw = (1 + np.log(counts)) * self.idf[ids]
        norm = np.sqrt(raw @ raw)
        return (ids, raw / norm) if norm else (ids[:0], raw[:0])

    def build(self, vectors: list[tuple[np.ndarray, np.ndarray]], dense: float = DENSE) -> None:
        """The inverted index of the examples' vectors."""
        blocks = -(-len(vectors) // BLOCK)
        example = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
        term, weight = (np.concatenate([v[i] for v in vectors] or [np.zeros(0)]) for i in range(2))
        term = term.astype(np.int64)
        often = np.flatnonzero(np.bincount(term, minlength=len(self.vocabulary)) >= max(1, dense * len(vectors)))
        self.row = np.full(len(self.vocabulary), -1, np.int32)
        self.row[often] = np.arange(len(often))
        mine = self.row[term] >= 0
        self.table = np.zeros((len(often), blocks * BLOCK))
        self.table[self.row[term[mine]], example[mine]] = weight[mine]
        term, example, weight = term[~mine], example[~mine], weight[~mine]
        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order].astype(np.int32), weight[order]
        key = term * (blocks + 1) + self.example // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.postings = np.append(first, len(key))
        self.block = self.example[first] // BLOCK
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        self.entries = np.searchsorted(term[first], np.arange(len(self.vocabulary) + 1))

    def nearest(self, vector: tuple[np.ndarray, np.ndarray], without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with any term in common, best first, ties by number."""
        ids, x = vector
        row = self.row[ids]
        often = row >= 0
        of_rows = np.zeros(len(self.table))
        of_rows[row[often]] = x[often]
        begun = of_rows @ self.table
        ids, x = ids[~often], x[~often]
        first, last = self.entries[ids], self.entries[ids + 1]
        entry, x = _ranges(first, last), np.repeat(x, last - first)
        block = self.block[entry]
        bound = np.bincount(block, x * self.most[entry], minlength=len(begun) // BLOCK) + begun.reshape(-1, BLOCK).max(1)
        order = np.argsort(-bound, kind="stable")
        rows, cosines, least, at, step = np.zeros(0, int), np.zeros(0), 0.0, 0, STEP
        while at < len(order):
            now = order[at : at + step]
            now = now[(bound[now] > 0) & (bound[now] >= least - 1e-12)]
            if not len(now):
                break
            at, step = at + step, 4 * step
            now = np.sort(now)
            opened = np.zeros(len(bound), bool)
            opened[now] = True
            mine = np.flatnonzero(opened[block])
            e = entry[mine]
            first, last = self.postings[e], self.postings[e + 1]
            posting = _ranges(first, last)
            score = np.bincount(self.example[posting], np.repeat(x[mine], last - first) * self.weight[posting], minlength=len(begun)) + begun
            if without >= 0:
                score[without] = 0
            score = score.reshape(-1, BLOCK)[now].ravel()
            found = np.flatnonzero(score >= max(least, 1e-15))
            rows, cosines = np.concatenate([rows, now[found // BLOCK] * BLOCK + found % BLOCK]), np.concatenate([cosines, score[found]])
            if len(rows) > self.k:
                likely = np.flatnonzero(cosines >= np.partition(cosines, -self.k)[-self.k])
                rows, cosines = rows[likely], cosines[likely]
                best = np.lexsort((rows, -cosines))[: self.k]
                rows, cosines = rows[best], cosines[best]
            least = cosines.min() if len(rows) == self.k else 0.0
        best = np.lexsort((rows, -cosines))
        return rows[best], cosines[best]

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Log-odds of label 1 among the neighbours, each smoothed towards the overall share."""
        weight = cosines**2
        one, zero = (weight * self.toxic[rows]).sum(), (weight * self.clean[rows]).sum()
        return float(np.log((one + self.base) / (zero + 1 - self.base)))

    def score(self, ids: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        none = np.zeros(0, int)
        if not len(ids) or not len(self.toxic):
            return self.plain, none, np.zeros(0)
        rows, cosines = self.nearest(self.vector(ids, counts))
        if not len(rows):
            return self.plain, none, np.zeros(0)
        z = self.slope * self.vote(rows, cosines) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), rows, cosines


def coherent(vectors: list[tuple[np.ndarray, np.ndarray]], size: int, block: int = BLOCK) -> np.ndarray:
    """An order of the vectors (over `size` terms) in which like ones share blocks: halved again and again along the main axis
    of their most frequent terms."""
    held = np.bincount(np.concatenate([ids for ids, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int64), minlength=size)
    often = np.argsort(-held, kind="stable")[:ALIKE]
    column = np.full(size, -1)
    column[often] = np.arange(len(often))
    table = np.zeros((len(vectors), len(often)))
    for i, (ids, x) in enumerate(vectors):
        at = column[ids]
        table[i, at[at >= 0]] = x[at >= 0]

    def halved(rows: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= block:
            return [rows]
        off = table[rows] - table[rows].mean(0)
        axis = off[np.argmax((off * off).sum(1))]
        for _ in range(8):
            axis = off.T @ (off @ axis)
            axis /= max(np.linalg.norm(axis), 1e-300)
        rows = rows[np.argsort(off @ axis, kind="stable")]
        half = (-(-len(rows) // block) + 1) // 2 * block
        return halved(rows[:half]) + halved(rows[half:])

    return np.concatenate(halved(np.arange(len(vectors))))


def telling(texts: list[tuple[str, int]], least_support: int = 4, significance: float = 15.0) -> set[str]:
    """The terms that go with a label: by the likelihood ratio of their presence in the examples' texts."""
    seen = {0: Counter(), 1: Counter()}
    total = Counter(label for _, label in texts)
    for text, label in texts:
        seen[label].update(terms(text).keys())
    out, n = set(), total[0] + total[1]
    for term in seen[0].keys() | seen[1].keys():
        a, b = seen[1][term], seen[0][term]
        if a + b < least_support:
            continue
        g = 0.0
        for got, size in ((a, total[1]), (b, total[0])):
            for x, share in ((got, (a + b) / n), (size - got, 1 - (a + b) / n)):
                if x > 0:
                    g += 2 * x * np.log(x / (size * share))
        if g >= significance:
            out.add(term)
    # a mark needs its term counted
    return out | {t.rpartition(" x")[0] for t in out if " x" in t}


def choose(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[list, dict[int, int]]:
    """((point, doc_id, text, label) of the examples; labelled rows by label)."""
    marks = labels.select(F.col("doc_id").alias("marked"), F.col("toxic").alias("label")).filter("label in (0, 1)")
    both = docs.select("doc_id", F.xxhash64("text").alias("h")).join(marks, F.col("doc_id") == F.col("marked")).select("doc_id", "h", "label")
    sizes = {r.label: r["count"] for r in both.groupBy("label").count().collect()}
    if not sizes:
        return [], {}
    share = F.when(F.col("label") == 1, F.lit(min(1.0, per_label / sizes.get(1, 1)))).otherwise(F.lit(min(1.0, per_label / sizes.get(0, 1))))
    point = F.pmod(F.xxhash64(F.lit("example"), "doc_id", "h"), F.lit(1 << 30)) / float(1 << 30)
    wanted = both.withColumn("point", point).filter(F.col("point") < share).select(F.struct("doc_id", "h", "label", "point").alias("w"))
    w = F.col("w")
    # about 2 * per_label rows
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), (F.col("doc_id") == w["doc_id"]) & (F.xxhash64("text") == w["h"]))
    return sorted((r.point, r.doc_id, r.text or "", r.label) for r in rows.select("doc_id", "text", w["label"].alias("label"), w["point"].alias("point")).collect()), sizes


def with_terms(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id, terms, counts: the vocabulary's terms in each text, in order, and how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(shared.value)
        for batch in batches:
            found = [find(text.as_py()) for text in batch.column(1)]
            ends = pa.array(np.cumsum([0, *(len(x[0]) for x in found)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[i] for x in found] or [np.zeros(0)]).astype(np.int32))) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["doc_id", "terms", "counts"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, terms array<int>, counts array<int>")


def document_frequencies(found: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """(documents, documents with each of `size` terms) of with_terms."""
    out = np.zeros(size, np.int64)
    counts = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    out[counts["term"].to_numpy()] = counts["df"].to_numpy()
    return found.count(), out


def learn(docs: DataFrame, labels: DataFrame, everything: DataFrame, per_label: int = 1500, k: int = 15) -> tuple[Index, DataFrame]:
    """(an index from the labelled rows of docs, with_terms of `everything`, which the document frequencies come from)."""
    rows, sizes = choose(docs, labels, per_label)
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    if len({label for *_, label in rows}) < 2:
        return Index({}, np.zeros(0), k=k, base=share, plain=share), with_terms(everything, {})
    strong = telling([(text, label) for _, _, text, label in rows])
    words = {w for _, _, text, _ in rows for w in WORD.findall(text.lower())}
    index = Index({t: i for i, t in enumerate(sorted(words | strong))}, np.zeros(0), k=k, base=share, plain=share)
    # the texts are gone through once: what is found is counted, and scored in the end
    seen = written(with_terms(everything, index.vocabulary), "terms")
    n, df = document_frequencies(seen, len(index.vocabulary))
    index.strong = np.array([t in strong for t in index.vocabulary])
    index.idf = np.maximum(np.log((n + 1) / (df + 0.5)), 0) * np.where(index.strong, 1.0, OTHERS)
    stands = {x: sizes[x] / max(sum(label == x for *_, label in rows), 1) for x in sizes}
    find, merged, empty = Finder(index.vocabulary), {}, [0.0, 0.0]
    for _, doc_id, text, label in rows:
        ids, counts = find(text)
        if not len(ids):
            empty[label] += stands[label]
            continue
        held = merged.setdefault(ids.tobytes() + counts.tobytes(), [[0.0, 0.0], doc_id, ids, counts])
        held[0][label] += stands[label]
        held[1] = min(held[1], doc_id)
    examples = list(merged.values())
    vectors = [index.vector(e[2], e[3]) for e in examples]
    order = coherent(vectors, len(index.vocabulary)).tolist()
    examples, vectors = [examples[i] for i in order], [vectors[i] for i in order]
    index.names = np.array([e[1] for e in examples], np.int64)
    index.clean, index.toxic = np.array([e[0][0] for e in examples]), np.array([e[0][1] for e in examples])
    index.plain = (empty[1] + share) / (sum(empty) + 1)
    index.build(vectors)
    # leave-one-out votes, then slope and shift by Newton's method with a little ridge
    z, one, zero = [], [], []
    for i, vector in enumerate(vectors):
        near, cosines = index.nearest(vector, without=i)
        z.append(index.vote(near, cosines))
        one.append(index.toxic[i])
        zero.append(index.clean[i])
    z, one, zero = np.array(z), np.array(one), np.array(zero)
    x, theta = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        weight = one + zero
        slope = x.T @ (weight * p - one) + 0.1 * (theta - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    index.slope, index.shift = (float(max(theta[0], 0.05)), float(theta[1]))
    return index, seen


def score(seen: DataFrame, index: Index, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted, evidence (the terms found that go with a label), neighbours (their number), nearest (cosine),
    voters (doc_ids of the neighbours, nearest first) of with_terms."""
    shared = seen.sparkSession.sparkContext.broadcast(index)
    schema = "doc_id long, score double, predicted int, evidence array<string>, neighbours int, nearest double, voters array<long>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        names = list(index.vocabulary)
        for batch in batches:
            out = []
            ends = batch.column(1).offsets.to_numpy()
            ids, counts = (batch.column(i).flatten().to_numpy() for i in (1, 2))
            for a, b in zip((ends[:-1] - ends[0]).tolist(), (ends[1:] - ends[0]).tolist(), strict=True):
                mine = ids[a:b]
                value, rows, cosines = index.score(mine, counts[a:b])
                shown = mine[index.strong[mine]] if b > a else mine
                out.append((value, int(value >= threshold), [names[t] for t in shown], len(rows), float(cosines[0]) if len(cosines) else 0.0, index.names[rows].tolist()))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.float64(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.float64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], ["doc_id", "score", "predicted", "evidence", "neighbours", "nearest", "voters"])

    return seen.select("doc_id", "terms", "counts").mapInArrow(task, schema)


def held_out(docs: DataFrame):
    """True for a quarter of the rows, by doc_id; a null doc_id is not held out."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 4 == 2, F.lit(False))


def assess(docs: DataFrame, labels: DataFrame, per_label: int = 1500) -> DataFrame:
    """score's columns and held_out; learned from the labels of the rows that are not held out."""
    index, seen = learn(docs.filter(~held_out(docs)), labels, docs, per_label)
    out = score(seen, index)
    return out.withColumn("held_out", held_out(out))
