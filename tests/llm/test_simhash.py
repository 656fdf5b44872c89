import random
import re

import numpy as np
import pytest
import xxhash

from locusframe.llm.simhash import bit_sliced_links, buckets, classes, components, keep_one, links, stars, tables
from test_repeats import SCHEMA, corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_components(nodes, linked):
    parent = {v: v for v in nodes}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in nodes}


def test_classes_match_brute_force(spark):
    r = random.Random(3)
    rows = [x for x in corpus(6)]
    rows += [(300 + i, " ".join(r.choice("ABc") for _ in range(r.randint(1, 6))), 1, "x") for i in range(60)]
    got = classes(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = [(d, fingerprint(t)) for d, t, *_ in rows]
    assert sorted(((x.doc_id, x.fingerprint) for x in got), key=str) == sorted(((d, f"{f:016x}") for d, f in prints), key=str)
    roots = brute_components({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for d, f in prints:
        if d is not None:
            least[roots[f]] = min(d, least.get(roots[f], d))
    assert sorted(((x.doc_id, x.component_id) for x in got), key=str) == sorted(((d, least.get(roots[f])) for d, f in prints), key=str)
    assert len(least) < len(roots)
    kept = keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(x.doc_id for x in kept if x.doc_id is not None) == sorted(least.values())


@pytest.mark.parametrize("radius, most", [(2, 4096), (2, 2), (4, 30)])
def test_links_join_what_brute_force_joins(spark, radius, most):
    r = random.Random(9)
    base = [r.getrandbits(64) for _ in range(20)]
    prints = set(base)
    for b in base:
        for _ in range(20):
            prints.add(b ^ sum(1 << x for x in r.sample(range(64), r.randint(1, radius + 2))))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    edges = links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius, most)
    label = {x.v: x.label for x in components(edges).collect()}
    roots = brute_components(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
    assert {v: label.get(v, v) for v in signed} == roots


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_tables_share_a_key_within_the_radius(radius):
    r = random.Random(radius)
    for within in ((1 << 64) - 1, ((1 << 21) - 1) << 40):
        masks = tables(radius, within)
        for _ in range(300):
            flip = sum(1 << b for b in r.sample([i for i in range(64) if within >> i & 1], radius))
            assert any(flip & m == 0 for m in masks)


@pytest.mark.parametrize("size", [20_000, 100_000])
def test_one_bucket_of_many_fingerprints(spark, size):
    # all differ only in the bits that one table ignores; which of them link is found by flipping bits
    ignored = [b for b in range(64) if not tables(2)[0] >> b & 1]
    r = np.random.default_rng(size)
    low = np.sort(r.choice(1 << len(ignored), size, replace=False))
    fp = np.zeros(size, np.uint64)
    for i, b in enumerate(ignored):
        fp |= ((low >> i & 1).astype(np.uint64)) << np.uint64(b)
    left, right = [], []
    for flip in [1 << i for i in range(len(ignored))] + [1 << i | 1 << j for i in range(len(ignored)) for j in range(i)]:
        at = np.minimum(np.searchsorted(low, low ^ flip), size - 1)
        hit = np.flatnonzero(low[at] == low ^ flip)
        left.append(hit)
        right.append(at[hit])
    want = stars(size, np.concatenate(left), np.concatenate(right))
    signed = fp.view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    assert buckets(df, 2, 4096).groupBy("t", "key").count().agg({"count": "max"}).first()[0] <= 4096
    edges = links(df, 2).toPandas()
    place = {x: i for i, x in enumerate(signed)}
    a, b = edges.a.map(place).to_numpy(), edges.b.map(place).to_numpy()
    assert np.array_equal(stars(size, a, b), want)


def test_bit_sliced_links():
    r = random.Random(1)
    fp = np.array([r.getrandbits(6) for _ in range(300)], np.uint64)
    group = np.sort(np.array([r.randrange(5) for _ in fp]))
    for radius in (0, 1, 2, 3):
        a, b = bit_sliced_links(fp, group, radius, most=500)
        want = {(i, j) for i in range(300) for j in range(i) if group[i] == group[j] and int(fp[i] ^ fp[j]).bit_count() <= radius}
        assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def test_long_path_and_empty(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)], "a long, b long")
    assert {r.label for r in components(edges).collect()} == {0}
    assert classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_and_repeated_rows(spark):
    # more shingles than a stretch of counters holds
    long = " ".join(f"w{(i * 7919) % 50021}" for i in range(70_000))
    rows = [(1, long), (2, long), (2, long), (None, long + " end"), (3, "short text")]
    got = classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert len(got) == 5 and by[1] == by[2] == {(f"{fingerprint(long):016x}", 1)} and {c for _, c in by[None]} == {1}
