"""Audit of filters that interact (operator 13).

Each document gets a mask of the filters that it fails. Masks are counted by part on Spark; a part's counts (2^filters at most)
become a decision diagram: a level a filter, two edges a node (fails, passes), equal nodes shared, and in each node the documents
that reach a leaf through it. Going through all orders of the filters by exchanges of two neighbours, only two levels are made
anew each time. In every order, the path on which all filters pass gives the steps: what a step removes is the weight of its
failing edge, what it keeps that of its passing edge.

Copies: a text is known by its SHA-256. The smallest doc_id of each text (aggregated before the shuffle) meets the rows by text
and doc_id, so that a text of a third of all rows does not meet in one task.

Defined results: null texts are empty, null sources the part ''; a null doc_id is no smaller than any other, and no other is
smaller than it; rows equal in doc_id and text all count, and none is a copy of the other; of several labels of a doc_id any
with quality 1 (toxic 1) counts; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.store import written

SEPARATORS = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILTERS = "ABCDE"


def text_failures(text: Column) -> Column:
    """A mask of what the text alone fails: A under 50 words, B few different words, C capitals, D symbols."""
    words = F.filter(F.split(text, SEPARATORS), lambda w: w != "")

    def bits(w: Column) -> Column:
        n, capitals = F.size(w), F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
        failed = (n < 50, 100 * F.size(F.array_distinct(w)) < 65 * n, 100 * capitals.cast("long") > 5 * F.char_length(text).cast("long"), text.rlike("[#$%&*|]"))
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))

    # bound to a name, so that the words are cut once
    return F.element_at(F.transform(F.array(words), bits), 1)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by part and by the filters that they fail (bit i: the i-th of FILTERS)."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["source"], F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("key"), text_failures(text).alias("mask"))
    rows = written(rows, "failures")
    seen = rows.groupBy("key", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first"))
    seen = seen.join(first.withColumnRenamed("key", "of"), (F.col("key") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left")
    copied = F.col("doc_id").isNotNull() & F.col("first").isNull()
    seen = seen.select("doc_id", "part", (F.col("mask") + F.when(copied, 16).otherwise(0)).alias("mask"), "n")
    marked = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("labelled"))
    marked = marked.agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic"))
    known = seen.filter("doc_id is not null").join(marked, F.col("doc_id") == F.col("labelled"), "left").select("part", "mask", "n", "good", "toxic")
    zero = F.lit(0).cast("long")
    rest = seen.filter("doc_id is null").select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    every = known.unionByName(rest)
    return every.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.col("n") * F.col(c)), zero).alias(c) for c in ("good", "toxic")])


class Node:
    """A node of a diagram: what fails goes to `fails`, what passes to `passes`; weight: (documents, good, toxic)."""

    __slots__ = ("fails", "passes", "weight")

    def __init__(self, fails: Node | None, passes: Node | None, weight: tuple[int, ...]):
        self.fails, self.passes, self.weight = fails, passes, weight


class Diagram:
    """A count-weighted decision diagram over failure masks; `order` has the filter of each level."""

    def __init__(self, filters: int, counts: dict[int, tuple[int, ...]]):
        none = (0,) * len(next(iter(counts.values()), (0,)))
        leaves: dict[tuple[int, ...], Node] = {}
        # from the last filter's level up: at[m] decides on what the earlier filters leave, m being their failures
        at = [leaves.setdefault(w, Node(None, None, w)) for m in range(1 << filters) for w in [counts.get(m, none)]]
        self.order = list(range(filters))
        self.levels: list[dict[tuple[int, int], Node]] = []
        for _ in range(filters):
            made: dict[tuple[int, int], Node] = {}
            half = len(at) // 2
            at = [self._node(made, at[half + m], at[m]) for m in range(half)]
            self.levels.insert(0, made)
        self.root = at[0]

    @staticmethod
    def _node(made: dict[tuple[int, int], Node], fails: Node, passes: Node) -> Node:
        key = (id(fails), id(passes))
        if key not in made:
            made[key] = Node(fails, passes, tuple(map(sum, zip(fails.weight, passes.weight, strict=True))))
        return made[key]

    def swap(self, i: int) -> None:
        """Exchange levels i and i + 1. The nodes of level i keep their places and weights, those of the next are made anew."""
        upper: dict[tuple[int, int], Node] = {}
        lower: dict[tuple[int, int], Node] = {}
        for node in self.levels[i].values():
            f, p = node.fails, node.passes
            node.fails, node.passes = self._node(lower, f.fails, p.fails), self._node(lower, f.passes, p.passes)
            upper[id(node.fails), id(node.passes)] = node
        self.levels[i], self.levels[i + 1] = upper, lower
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, removed, kept) along the path on which all pass."""
        node = self.root
        for f in self.order:
            yield f, node.fails.weight, node.passes.weight
            node = node.passes


def exchanges(n: int) -> list[int]:
    """Places i, n! - 1 of them: exchanging the items at i and i + 1 one after the other gives every order of n once."""
    if n < 2:
        return []
    out: list[int] = []
    inner, down = [*exchanges(n - 1), None], True
    for at in inner:
        out += range(n - 2, -1, -1) if down else range(n - 1)
        if at is not None:
            # the last item stands at one end; the exchange of the others moves by one if that end is the first
            out.append(at + down)
        down = not down
    return out


def audit(filters: int, counts: dict[int, tuple[int, ...]]) -> Iterator[tuple]:
    """(order, step from 0, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order."""
    diagram = Diagram(filters, counts)
    walks = [(tuple(diagram.order), list(diagram.steps()))]
    for i in exchanges(filters):
        diagram.swap(i)
        walks.append((tuple(diagram.order), list(diagram.steps())))
    failing, alone, shapley = [0] * filters, [0] * filters, [0] * filters
    for _, steps in walks:
        failing[steps[0][0]] = steps[0][1][0]
        alone[steps[-1][0]] = steps[-1][1][0]
        for f, removed, _ in steps:
            shapley[f] += removed[0]
    for order, steps in walks:
        for k, (f, removed, kept) in enumerate(steps):
            yield order, k, f, kept[0], removed[0], failing[f] - removed[0], alone[f], removed[1], removed[2], shapley[f]


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and counts: a row for every part, order of FILTERS and step."""
    per = masks(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(audit(len(FILTERS), {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counts}))
                numbers = np.array([r[3:] for r in rows], np.int64)
                own = [pa.array([part] * len(rows)), pa.array(["".join(FILTERS[f] for f in r[0]) for r in rows]), pa.array([r[1] + 1 for r in rows], pa.int32())]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(numbers[:, i]) for i in range(len(_COUNTS)))], ["part", "filter_order", "step", *_COUNTS])

    return per.mapInArrow(task, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS))


ORACLE = """
WITH marked AS (
  SELECT doc_id, max(CAST(coalesce(quality, 0) = 1 AS INTEGER)) AS good, max(CAST(coalesce(toxic, 0) = 1 AS INTEGER)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
failed AS (
  SELECT b.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
    CAST(len(words) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INTEGER)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER) + 16 * CAST(coalesce(b.doc_id > min(b.doc_id) OVER (PARTITION BY text), false) AS INTEGER) AS mask
  FROM base b LEFT JOIN marked m ON b.doc_id = m.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
bits AS (
  SELECT filter_order, step, CAST(1 << (ascii(filter_order[step]) - 65) AS INTEGER) AS own,
    CAST(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))) AS INTEGER) AS before
  FROM steps),
walked AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (own | coalesce(before, 0)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0) = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own <> 0 AND mask & coalesce(before, 0) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts CROSS JOIN bits GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM walked
"""
