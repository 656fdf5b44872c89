import random
import re
from collections import Counter

import duckdb
import pandas as pd

from locusframe.llm.mixing import ORACLE, mix, mixed


def rows():
    r = random.Random(8)
    out = [(i, " ".join("w" for _ in range(r.randint(0, 40))), r.choice(["é", "b", "a", "zz", None] + ["hot"] * 5), "x") for i in range(300)]
    return out + [(900, None, "a", "x"), (901, "", "tiny", "x"), (902, "one two", "tiny", "x"), (903, "one two", "aa", "x")]


SCHEMA = "doc_id long, text string, source string, rank string"


def test_matches_sql_and_targets(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = mix(df).select("doc_id", "size", "source_size", "target", "taken").toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows(), columns=["doc_id", "text", "source", "rank"]))
    want = con.execute(ORACLE).df()
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert got.sort_values("doc_id")[columns].values.tolist() == want.sort_values("doc_id")[columns].values.tolist()
    assert (got["taken"] <= 3 * got["size"]).all()
    source = {d: s for d, _, s, _ in rows()}
    total = got["size"].sum()
    per = got.groupby(got["doc_id"].map(lambda d: str(source[d])))
    assert abs(per["target"].first().sum() - total) < 1e-6
    for _, g in per:
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 8 and g["target"].iloc[0] <= 3 * g["source_size"].iloc[0]


def test_mixed_rows_hold_the_words_taken(spark):
    df = spark.createDataFrame(rows() + [(902, "one two", "tiny", "x")], SCHEMA)
    taken = Counter()
    for r in mix(df).collect():
        taken[r.doc_id] += r.taken
    out = mixed(df)
    assert out.columns == df.columns
    held = Counter()
    for r in out.collect():
        held[r.doc_id] += len(re.findall(r"\S+", r.text))
    assert all(abs(held[d] - n) <= 1 for d, n in taken.items())


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mix(df).count() == 0 and mixed(df).count() == 0
    none = spark.createDataFrame([(1, None, None, "x"), (2, " ", "a", "x")], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in mix(none).collect()] == [(0, 0.0, 0)] * 2


def test_small_sources_come_near_their_targets_with_few_slots(spark):
    r = random.Random(1)
    data = [(i, " ".join("w" for _ in range(r.randint(200, 900))), f"s{i % 3}", "x") for i in range(600)]
    data += [(1000 + i, " ".join("w" for _ in range(20)), "tiny", "x") for i in range(5)] + [(2000 + i, "a b c d e f g", "u", "x") for i in range(200)]
    got = mix(spark.createDataFrame(data, SCHEMA), slots=64).toPandas()
    for _, g in got.groupby("source"):
        target, size = g["target"].iloc[0], g["source_size"].iloc[0]
        assert abs(g["taken"].sum() - target) <= max(8, 0.02 * size), (target, size, g["taken"].sum())
    assert (got["taken"] <= 3 * got["size"]).all()


def test_null_ids_and_repeated_rows(spark):
    data = [(None, "a b c", "x", "r")] * 3 + [(1, "d e", "x", "r")] * 2 + [(2, "f", None, None)]
    got = mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == 6 and all(0 <= r.taken <= 3 * r.size for r in got)


def test_columns_of_any_name(spark):
    names = ("mix_plan", "mix_part", "mix_h", "mix_text", "doc", "h", "taken", "size", "rid")
    data = [(i, f"a b c {i}", "s", 7, *["x"] * len(names)) for i in range(6)] + [(None, "n u l l", None, 1, *[None] * len(names))]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, n_chars int, " + ", ".join(f"{c} string" for c in names))
    out = mixed(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    rows = out.collect()
    assert rows and all(r.n_chars == len(r.text) and r.doc in ("x", None) for r in rows)
    assert mix(df).count() == 7
