import random
import zlib
from collections import Counter

import numpy as np
import pytest

from locusframe.llm import language, toxicity


def words(r, letters, n):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(n))


def documents():
    r = random.Random(4)
    rows = []
    for i in range(400):
        lang, letters = (("xx", "abcdeé"), ("yy", "uvwxyñ"), ("zz", "abuvmn"))[i % 3]
        text = words(r, letters, 30)
        if i % 8 == 1:
            text += " vileword" * r.randint(1, 2) + " Nasty, "
        rows.append((i, text, lang if i % 20 else None, "s"))
    return rows + [(1000, None, "xx", "s"), (1001, "", "yy", "s"), (1002, "12 34 !!", "zz", "s"), (1003, "日本語", None, "s"), (None, "abcde abd", None, "s")]


SCHEMA = "doc_id long, text string, lang string, score string"


def test_language_held_out_accuracy(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    got = {r.doc_id: r for r in language.identify(df).collect()}
    rows = documents()
    assert len(got) == len(rows)
    for d, *_ in rows:
        assert got[d].held_out == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2)
    held = [(got[d], t, lang) for d, t, lang, _ in rows if got[d].held_out and lang and t and any(c.isalpha() for c in t)]
    assert sum(r.lang_pred == lang for r, _, lang in held) >= 0.95 * len(held) > 40
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (1000, 1001, 1002))
    assert got[1003].lang_pred != "und" and all(0 <= r.score <= 1 for r in got.values())


def test_language_without_labels_and_empty(spark):
    df = spark.createDataFrame([(1, "abc", None, "s")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language.identify(df).collect()] == [("und", 0.0)]
    assert language.identify(df.limit(0)).count() == 0


def test_language_rejects_below_its_threshold():
    r = random.Random(1)
    texts = [words(r, "abc", 20) for _ in range(60)] + [words(r, "xyz", 20) for _ in range(60)]
    model = language.train(language.counted(texts), ["a"] * 60 + ["x"] * 60)
    assert model.languages == ["a", "x"] and 0 < model.reject_below <= 1 and model.temperature > 0


def test_language_learns_each_of_600(spark):
    # a language is a pair of letters; three rows of each, of the first a third of all
    r = random.Random(8)
    names = [f"l{i:03}" for i in range(600)]
    pairs = r.sample([a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz" if a != b], 600)
    rows = [(i * 600 + j, words(r, pairs[j], 25), name, "s") for i in range(3) for j, name in enumerate(names)]
    rows += [(5000 + i, words(r, pairs[0], 25), names[0], "s") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    chosen, known = language.sample(df, 400, 1000)
    counts = Counter(x.lang for x in chosen.select("lang").collect())
    assert known == len(counts) == 600 and sum(counts.values()) < 1500
    # a row repeated counts once
    assert language.sample(spark.createDataFrame([rows[0]] * 500, SCHEMA), 400, 1000)[0].count() == 1
    model = language.learn(df, examples=1000, epochs=2)
    assert model.languages == names and model.table.shape[0] == 16
    # a language's share of entries is less than a text has: one text of each is left, no language is lost
    assert language.learn(df, examples=1000, entries=600, epochs=1).languages == names
    got = language.predict(df, model).collect()
    assert len(got) == len(rows) and {x.lang_pred for x in got} <= set(names)


def test_language_table_or_embedding_give_the_same(spark):
    r = random.Random(2)
    sets = ["abc", "xyz", "klm", "rst"]
    texts = [words(r, sets[i % 4], 20) for i in range(80)]
    counts, labels = language.counted(texts), [str(i % 4) for i in range(80)]
    one, other = (language.train(counts, labels, width=w) for w in (4, 3))
    assert one.table.shape[0] == 4 and other.table.shape[0] == 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for model in (one, other):
        assert [x.lang_pred for x in language.predict(df, model).orderBy("doc_id").collect()] == labels


def index(dense, seed=3, n=300):
    r = random.Random(seed)
    out = toxicity.Index({f"t{i}": i for i in range(40)}, np.array([r.uniform(0.5, 4) for _ in range(40)]), k=10)
    seen = {tuple(sorted(Counter(min(r.randrange(40), r.randrange(40)) for _ in range(r.randint(1, 8))).items())) for _ in range(n)}
    vectors = [out.vector(*np.array(s).T) for s in sorted(seen)]
    out.toxic, out.clean = np.array([r.random() for _ in vectors]), np.array([r.random() for _ in vectors])
    out.build(vectors, dense)
    return out, vectors, r


@pytest.mark.parametrize("dense", [2.0, 1 / 8, 0.0])
def test_nearest_is_exact(dense):
    made, vectors, r = index(dense)
    table = np.zeros((len(vectors), 40))
    for i, (ids, x) in enumerate(vectors):
        table[i, ids] = x
    for _ in range(100):
        ids, x = made.vector(*np.array(sorted(Counter(r.choices(range(40), k=r.randint(1, 6))).items())).T)
        query = np.zeros(40)
        query[ids] = x
        want = table @ query
        rows, cosines = made.nearest((ids, x))
        best = np.sort(want[want > 0])[::-1][:10]
        assert cosines == pytest.approx(best) and want[rows] == pytest.approx(cosines)
        out = made.nearest((ids, x), without=int(rows[0]))[0]
        assert rows[0] not in out


def test_like_examples_share_blocks():
    r, size = random.Random(9), 400
    vectors = []
    for i in range(8 * toxicity.BLOCK - 5):
        topic = i % 8 * 50
        ids = np.array(sorted({r.randrange(topic, topic + 50) for _ in range(12)} | {r.randrange(size)}))
        vectors.append((ids, np.full(len(ids), len(ids) ** -0.5)))
    order = toxicity.coherent(vectors, size)
    assert sorted(order.tolist()) == list(range(len(vectors))) and toxicity.coherent([], size).tolist() == []
    same = toxicity.coherent([vectors[0]] * 100, size)
    assert sorted(same.tolist()) == list(range(100))
    built = []
    for rows in (range(len(vectors)), order.tolist()):
        out = toxicity.Index({str(i): i for i in range(size)}, np.ones(size))
        out.build([vectors[i] for i in rows], 2.0)
        built.append(out)
    assert 2 * len(built[1].postings) < len(built[0].postings)
    for v in vectors[:40]:
        (_, want), (rows, got) = (x.nearest(v) for x in built)
        assert got == pytest.approx(want)
        assert got == pytest.approx([sum(dict(zip(*v))[t] * y for t, y in zip(*vectors[order[i]]) if t in dict(zip(*v))) for i in rows])


def test_finder_matches_counting():
    r = random.Random(5)
    texts = [words(r, "abc", r.randint(0, 60)) for _ in range(50)] + [None, "", "Aaaa aaaa AAAA aaaa aaaa"]
    every = sorted({t for x in texts for t in toxicity.terms(x)})
    wanted = {t: i for i, t in enumerate(t for t in every if r.random() < 0.6)}
    wanted |= {b: len(wanted) + i for i, b in enumerate(sorted({t.rpartition(" x")[0] for t in wanted if " x" in t} - set(wanted)))}
    find = toxicity.Finder(wanted)
    for text in texts:
        ids, counts = find(text)
        assert dict(zip(ids.tolist(), counts.tolist(), strict=True)) == {wanted[t]: n for t, n in toxicity.terms(text).items() if t in wanted}
        assert list(ids) == sorted(ids)


def test_toxicity_held_out(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    marks = [(i, int(i % 8 == 1), "x") for i in range(400) if i % 3] + [(5, None, "x"), (7, 9, "x"), (None, 1, "x")]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity.assess(df, labels).collect()}
    assert len(got) == len(documents())
    held = [d for d in range(400) if got[d].held_out]
    assert all(got[d].predicted == int(d % 8 == 1) for d in held) and len(held) > 50
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    assert got[1000].score == got[1001].score < 0.3 and "vileword" in got[1].evidence
    label = {d: x for d, x, _ in marks}
    voted = [d for r in got.values() for d in r.voters]
    assert all(label[d] in (0, 1) and not got[d].held_out for d in voted) and all(len(r.voters) == r.neighbours <= 15 for r in got.values())
    assert all(label[got[d].voters[0]] == 1 for d in held if got[d].predicted)


def test_toxicity_one_label_and_empty(spark):
    df = spark.createDataFrame(documents()[:20], SCHEMA)
    labels = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.assess(df, labels).collect()} == {0.0}
    assert toxicity.assess(df, labels.limit(0)).count() == 20 and toxicity.assess(df.limit(0), labels).count() == 0


def test_toxicity_repeated_rows_and_very_long_text(spark):
    rows = documents()[:200]
    long = "word another " * 60_000 + "vileword"
    df = spark.createDataFrame(rows + rows[:40] + [(900, long, "xx", "s"), (901, long, "xx", "s")], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 8 == 1)) for i in range(200)], "doc_id long, toxic int")
    got = toxicity.assess(df, labels).collect()
    assert len(got) == 242
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(x) == 1 for x in scores.values()) and scores[900] == scores[901]


def test_language_repeated_rows_and_very_long_text(spark):
    rows = documents()
    long = rows[0][1] * 3000
    got = language.identify(spark.createDataFrame(rows + rows[:30] + [(2000, long, None, "s")], SCHEMA)).collect()
    assert len(got) == len(rows) + 31
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.lang_pred, r.score))
    assert all(len(x) == 1 for x in by.values()) and {x for x, _ in by[2000]} == {"xx"}
