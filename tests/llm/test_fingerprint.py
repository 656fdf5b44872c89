import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from locusframe.llm.fingerprint import combine, edits, fingerprint, text_of, with_next
from test_repeats import SCHEMA


def rows(n=60):
    r = random.Random(2)
    vocabulary = ["".join(r.choice("abcdefghé") for _ in range(5)) for _ in range(3000)]
    out = [(i * 7, "\n".join(" ".join(r.choice(vocabulary) for _ in range(r.randint(5, 60))) for _ in range(r.randint(1, 9))), 1, "a") for i in range(n)]
    return out + [(1000, None, 1, "a"), (1001, "", 1, "a"), (1002, "x", 1, "a"), (1003, out[3][1], 1, "a"), (None, "no id", 1, "a")]


def edited(text, other):
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def test_edits_against_brute_force(spark):
    data = rows()
    ordered = sorted(((d if d is not None else -(2**63), t or "") for d, t, *_ in data), reverse=True)
    want = {d: (len(t), hashlib.sha256(edited(t, ordered[(i + 1) % len(ordered)][1]).encode()).hexdigest()) for i, (d, t) in enumerate(ordered)}
    got = edits(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(-(2**63) if r.doc_id is None else r.doc_id): (r.n_chars, r.edited_sha256) for r in got} == want and len(got) == len(data)
    by = {r.doc_id: r for r in got}
    assert by[21].fingerprint == by[1003].fingerprint and by[1000].fingerprint == by[1001].fingerprint != by[1002].fingerprint
    body = [by[i * 7] for i in range(1, 60)]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert sum(r.near_edited > r.near_next for r in body) >= 57
    assert 0.35 < sum(r.near_edited for r in body) / 59 < 0.65 and sum(r.near_next for r in body) / 59 < 0.2
    assert all((r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint) for r in got)


def test_order_independent_and_incremental(spark):
    df = spark.createDataFrame([("a b\nc d e\nf", "f\na b\nc d e", "a b\nc d e")], "x string, y string, z string")
    r = df.select(
        text_of(fingerprint(F.col("x"))).alias("x"),
        text_of(fingerprint(F.col("y"))).alias("y"),
        text_of(combine(fingerprint(F.col("z")), fingerprint(F.lit("f")))).alias("added"),
        text_of(combine(fingerprint(F.col("x")), fingerprint(F.lit("f")), -1)).alias("removed"),
        text_of(fingerprint(F.col("z"))).alias("z"),
    ).first()
    assert r.x == r.y == r.added and r.removed == r.z != r.x


def test_next_with_repeated_ids_and_one_row(spark):
    df = spark.createDataFrame([(5, t, 1, "a") for t in "abc"] + [(4, "d", 1, "a")], SCHEMA)
    for parts in (1, 3, 10):
        got = sorted((r.text, r.next_text) for r in with_next(df, {}, parts).collect())
        order = dict(got)
        assert len(got) == 4 and order["d"] in "abc" and len(set(order.values())) == 4
    one = with_next(df.filter("doc_id = 4"), {}, 4).collect()
    assert [(r.text, r.next_text) for r in one] == [("d", "d")]
    assert edits(df.limit(0)).count() == 0


def test_ties_and_nulls_in_many_ranges(spark):
    texts = [f"line {i}\nother {i % 7} text" for i in range(60)]
    rows = [(5, t, "x") for t in texts] + [(None, f"n{i}", "x") for i in range(30)] + [(i, f"t{i}", "x") for i in range(20)] + [(5, texts[0], "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(((d if d is not None else -(1 << 63), hashes[t], t) for d, t, _ in rows), reverse=True)
    want = Counter((a[2], b[2]) for a, b in zip(order, order[1:] + order[:1], strict=True))
    for parts in (1, 4, 40):
        got = Counter((r.text, r.next_text) for r in with_next(df, {}, parts).collect())
        assert got == want, parts


def test_very_long_text(spark):
    text = "\n".join(f"paragraph {i} of many words, the end" for i in range(30_000))
    got = edits(spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")).collect()
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint != by[3].fingerprint and by[2].near_next == 1 and by[1].n_chars == len(text)
