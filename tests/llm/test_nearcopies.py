import random

import corpus_pipeline
from test_simhash import WORD, brute_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = WORD.findall((text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def linked(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b) > 0


def test_stage_joins_what_brute_force_joins(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    texts = [None, "", "one two", "One  two", "one two three"]
    for _ in range(40):
        base = [word() for _ in range(r.randint(50, 200))]
        texts.append(" ".join(base))
        for _ in range(12):
            # from almost equal to well under 0.8
            copy = list(base)
            for _ in range(r.randint(1, max(2, len(base) // 30))):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    # drifting copies: each is near the one before only
    chain = [word() for _ in range(120)]
    for i in range(0, 60, 2):
        chain[i * 2] = word()
        texts.append(" ".join(chain))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    roots = brute_components(list(sets), lambda a, b: linked(sets[a], sets[b]))
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(roots.values()))
    assert len(set(roots.values())) < len(texts) / 2


def test_simhash_candidates_are_searched_and_checked(spark, monkeypatch):
    from locusframe.llm import nearcopies

    # without the min-hash side, what operator 8 joins is still found, and checked
    monkeypatch.setattr(nearcopies, "AGREE", 105)
    r = random.Random(1)
    base = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    rows = [(0, " ".join(base)), (1, " ".join([*base, "x"])), (2, " ".join(base[:-1])), (3, " ".join(base[::-1]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    assert sorted(x.doc_id for x in nearcopies.keep_one(docs).collect()) == [0, 3]


def test_open_buckets_in_blocks(spark, monkeypatch):
    from locusframe.llm import nearcopies

    # copies of one text that is not there, most pairs of them just below 0.8: buckets stay open and are cut into blocks
    monkeypatch.setattr(nearcopies, "SIDE", 16)
    r = random.Random(7)
    base = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(150)]
    texts = []
    for _ in range(120):
        copy = list(base)
        for _ in range(r.randint(1, 4)):
            copy[r.randrange(len(copy))] = "".join(r.choice("abcdefgh") for _ in range(6))
        texts.append(" ".join(copy))
    sets = [shingles(t) for t in texts]
    roots = brute_components(list(range(len(sets))), lambda a, b: linked(sets[a], sets[b]))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    assert sorted(x.doc_id for x in nearcopies.keep_one(docs).collect()) == sorted(set(roots.values()))
    # no pair is a row: the step's only join is that of blocks
    sketches = nearcopies.with_sketches(docs)
    rows = sketches.selectExpr("s", "n", "posexplode(keys) as (t, key)", "s as label")
    own = sketches.selectExpr("s", "n", "keys", "mins", "struct(false as none, doc_id, rid) as least")
    got = nearcopies.across(docs, own, rows.select("t", "key", "s", "n", "label")).collect()
    near = {frozenset((a, b)) for a in range(120) for b in range(a) if linked(sets[a], sets[b])}
    names = {x.s: x.doc_id for x in sketches.select("s", "doc_id").collect()}
    assert brute_components(list(range(120)), lambda a, b: frozenset((a, b)) in near) == brute_components(list(range(120)), lambda a, b: frozenset((a, b)) in {frozenset((names[x.a], names[x.b])) for x in got})


def test_only_texts_of_likely_pairs_are_moved(spark, monkeypatch):
    from locusframe.llm import nearcopies

    r = random.Random(3)
    texts = [" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(80)) for _ in range(60)]
    texts += [f"{texts[0]} one", f"{texts[0]} two"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(1)
    sketches = nearcopies.with_sketches(docs)
    own = sketches.selectExpr("s", "n", "keys", "mins", "struct(false as none, doc_id, rid) as least")
    # all stand in one bucket by the first band's key, as sets that share a band by chance do
    rows = sketches.selectExpr("0 as t", "7L as key", "s", "n", "s as label")
    moved, with_sets = [], nearcopies.with_sets
    monkeypatch.setattr(nearcopies, "with_sets", lambda texts: moved.append(texts.count()) or with_sets(texts))
    names = {x.s: x.doc_id for x in sketches.select("s", "doc_id").collect()}
    got = nearcopies.across(docs, own, rows).collect()
    assert {names[v] for x in got for v in (x.a, x.b)} == {0, 60, 61} and moved == [3]


def test_rows_are_marked_by_their_keys(spark, monkeypatch):
    from locusframe.llm import nearcopies

    rows = spark.range(4000).selectExpr("xxhash64(id) as rid", "id as i")
    keys = rows.filter("i % 20 = 0").select("rid")
    hits = [x.i for x in nearcopies.marked(rows, keys).filter("hit").collect()]
    assert sorted(hits) == list(range(0, 4000, 20))
    # a table that is too full rules out nothing, and still loses nothing
    monkeypatch.setattr(nearcopies, "MARKS", 2)
    assert set(range(0, 4000, 20)) < {x.i for x in nearcopies.marked(rows, keys).filter("hit").collect()}
    assert nearcopies.marked(rows, keys.limit(0)).filter("hit").count() == 0


def test_repeated_rows_are_one_and_clashing_columns_stay(spark):
    from locusframe.llm import nearcopies

    row = (5, "some text of a few words here", 1, 2)
    docs = spark.createDataFrame([row, row, (None, "other words", 1, 3), (6, None, 2, 2), (7, "", 2, 2)], "doc_id long, text string, word int, rid int")
    got = nearcopies.keep_one(docs)
    assert got.columns == docs.columns and sorted(got.collect(), key=str) == sorted([row, (None, "other words", 1, 3), (6, None, 2, 2)], key=str)
