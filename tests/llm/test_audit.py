import random
import re
from itertools import permutations
from math import factorial

import pytest

from locusframe.llm import audit

DOCS = "doc_id long, text string, source string, part string, key int"
LABELS = "doc_id long, quality int, toxic int, part string"


def failures(rows):
    first = {}
    for d, t, *_ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, t, s, *_ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), d is not None and d > first[t])
        yield d, s or "", "".join(c for c, f in zip("ABCDE", failed, strict=True) if f)


def brute(rows, labels):
    good, toxic = {d for d, q, _, *_ in labels if q == 1} - {None}, {d for d, _, t, *_ in labels if t == 1} - {None}
    by = {}
    for d, s, f in failures(rows):
        by.setdefault(s, []).append((d, f))
    out = {}
    for s, docs in by.items():
        sums = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for k, c in enumerate(order):
                gone = [x for x in left if c in x[1]]
                left = [x for x in left if c not in x[1]]
                sums[c] += len(gone)
                fails = sum(c in f for _, f in docs)
                out[s, "".join(order), k + 1] = [len(left), len(gone), fails - len(gone), sum(f == c for _, f in docs), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), c]
        for key, v in out.items():
            if key[0] == s:
                v[6] = sums[v[6]]
    return out


def made_rows():
    r = random.Random(5)
    texts = [None, "", " ", "a", "A B", "x" * 20_000 + " y" * 40_000]
    for _ in range(120):
        n = r.choice([3, 49, 50, 51, 80])
        words = [r.choice(["ab", "Cd", "EF", "g", "h"]) if r.random() < r.choice([0.1, 0.6]) else f"w{r.randint(0, 9999)}" for _ in range(n)]
        texts.append(r.choice([" ", "\n", "\t \x0b", "\u00a0"]).join(words) + r.choice(["", "", "#", "|"]))
    rows = [(i, r.choice(texts), r.choice(["s", "s", "é", "", None]), "p", 0) for i in range(400)]
    return rows + [(7, "same", "s", "p", 0)] * 2 + [(None, "same", "s", "p", 0), (None, "same", None, "p", 0), (6, "same", "é", "p", 0), (5, "earliest", "u", None, None), (9, "earliest", "u", None, None)]


def test_equals_brute_force(spark):
    r = random.Random(6)
    rows = made_rows()
    labels = [(d, r.choice([0, 1, None]), r.choice([0, 0, 1]), "p") for d in range(0, 300)] + [(7, 1, 0, "p"), (7, 0, 1, "p"), (None, 1, 1, "p")]
    got = audit.interactions(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert {(x.part, x.filter_order, x.step): list(x)[3:] for x in got} == brute(rows, labels)
    assert len(got) == 600 * len({x.part for x in got})


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.interactions(docs, labels).count() == 0
    one = audit.interactions(spark.createDataFrame([(1, "a", "s", "", 1)], DOCS), labels).collect()
    assert len(one) == 600 and all(x.shapley == (120 if x.filter_order[x.step - 1] == "A" else 0) for x in one)


@pytest.mark.parametrize("n", range(1, 7))
def test_exchanges_go_through_every_order(n):
    order = list(range(n))
    seen = {tuple(order)}
    for i in audit.exchanges(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        seen.add(tuple(order))
    assert len(seen) == factorial(n) == len(audit.exchanges(n)) + 1


def test_a_swap_keeps_the_function_and_shares_nodes():
    r = random.Random(2)
    counts = {m: (r.randint(0, 2), 0, 0) for m in range(64)}
    d = audit.Diagram(6, counts)
    for i in [0, 3, 4, 1, 2, 0, 4, 3]:
        d.swap(i)
        for m in range(64):
            node = d.root
            for f in d.order:
                node = node.fails if m >> f & 1 else node.passes
            assert node.weight == counts[m]
        for level in d.levels:
            assert len({(id(n.fails), id(n.passes)) for n in level.values()}) == len(level)
        # at most three leaves, so at most nine nodes on the last level
        assert len(d.levels[-1]) <= 9
