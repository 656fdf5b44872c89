import random
from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline
from locusframe.llm.store import written
from test_mixing import ORACLE
from test_pii import base, revealing
from test_quality import brute as measures
from test_simhash import brute_components, fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rewritten(text, terms):
    spans = sorted((int(a), int(b), kind) for kind, a, b in (x.split(":") for x in base(text) + terms))
    out, at = "", 0
    for a, b, kind in spans:
        if a >= at:
            out += text[at:a] + f"[{kind.upper()}]"
        at = max(at, b)
    return out + text[at:]


def documents():
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 8))) for _ in range(4000)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(40, 120))) + (f" ask zebulon{'xyz'[i // 9 % 3]} by mail p{i // 9 % 3}@q.org." if i % 9 == 0 else ""), "en", f"s{i % 4}") for i in range(120)]
    rows += [(200 + i, rows[5][1] + (" x" if i % 2 else ""), "en", "s0") for i in range(6)]
    rows += [(300, "the same line here\n" * 30, "en", "s1"), (301, None, None, None), (302, "", "en", "s1")]
    return [(d, t, lang, s, len(t or "")) for d, t, lang, s in rows]


def test_stages_against_brute_force(spark, tmp_path):
    spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages, at = {}, docs
    for name, f in corpus_pipeline.STAGES:
        at = written(f(spark, at, str(tmp_path)), name)
        stages[name] = at.collect()
    assert all(list(stages[n][0].asDict()) == COLUMNS for n in list(stages)[:-1])

    def good(text):
        m = measures(text)
        return m["kept"] and not m["base_failed"]

    kept = {d: t for d, t, *_ in documents() if good(t)}
    assert {r.doc_id: r.text for r in stages["quality"]} == kept and 300 not in kept and len(kept) > 80
    prints = {d: fingerprint(t) for d, t in kept.items()}
    roots = brute_components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for d, f in prints.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    assert sorted(r.doc_id for r in stages["near_dedup"]) == sorted(least.values()) and len(least) < len(kept)
    clean = {r.doc_id: r.text for r in stages["pii"]}
    ids = sorted(least.values())
    _, terms = revealing([kept[d] for d in ids])
    assert clean == {d: rewritten(kept[d], t) for d, t in zip(ids, terms, strict=True)} and sum("[TERM]" in t for t in clean.values()) > 5
    assert all(r.n_chars == len(r.text) for r in stages["pii"] + stages["mixing"])
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(r.doc_id, r.text, r.source) for r in stages["pii"]], columns=["doc_id", "text", "source"]))
    taken = dict(con.execute(f"SELECT doc_id, taken FROM ({ORACLE})").fetchall())
    words = Counter()
    for r in stages["mixing"]:
        words[r.doc_id] += len(r.text.split())
    assert dict(words) == {d: n for d, n in taken.items() if n}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((r.doc_id, tuple(sp.encode(r.text))) for r in stages["mixing"])
    assert Counter((r.doc_id, tuple(r.ids)) for r in stages["sentencepiece"]) == want
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(stages["mixing"])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_and_clashing_columns_and_repeated_rows(spark, tmp_path):
    rows = [(*x, "kept?", i) for i, x in enumerate(documents()[:60])] + [(*documents()[3], "kept?", 99)] * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, rid int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, f in corpus_pipeline.STAGES[:-1]:
        at = written(f(spark, at, str(tmp_path)), name)
        assert at.columns == [*COLUMNS, "kept", "rid"], name
    assert {r.kept for r in at.collect()} == {"kept?"} and corpus_pipeline.run(spark, str(tmp_path)).count() == at.count() > 0
