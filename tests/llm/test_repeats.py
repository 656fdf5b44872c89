import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from locusframe.llm.rlz import remove_repeats
from locusframe.llm.suffixes import remove_repeated_bytes, repeated_starts, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, rid int, anchor string"


def corpus(seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 4))) for _ in range(60)]
    passages = [" ".join(r.choice(vocabulary) for _ in range(n)) for n in (34, 35, 36, 60, 90, 200)]
    texts = [None, "", " \n ", "x", " ".join("a" for _ in range(80)), " ".join("ab"[i % 2] for i in range(75))]
    for _ in range(40):
        parts = []
        for _ in range(r.randint(1, 4)):
            parts.append(" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60))))
            if r.random() < 0.6:
                p = r.choice(passages).split()
                parts.append(" ".join(p[r.randint(0, 5) :]))
        texts.append(("\n" if r.random() < 0.3 else " ").join(parts))
    base = texts[-1]
    texts += [base, base, base.replace("a", "b", 1), base[3:], base + " end"] + [" ".join(r.choice(vocabulary) for _ in range(4)) + " " + passages[3] + f" t{i}" for i in range(50)]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    return rows + [(7, texts[7], 1, "x"), (None, texts[8], 1, "x"), (9, "another text with this doc_id", 1, "x")]


def brute(rows, split, k):
    tokens = [split(t or "") for _, t, *_ in rows]
    count = Counter(tuple(x[i : i + k]) for x in tokens for i in range(len(x) - k + 1))
    out = []
    for (doc, *_), x in zip(rows, tokens, strict=True):
        gone = [False] * len(x)
        for i in range(len(x) - k + 1):
            if count[tuple(x[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        out.append((doc, x, gone))
    return out


def test_words_match_brute_force(spark):
    rows = corpus()
    want = Counter((d, len(x), sum(g), hashlib.sha256(" ".join(w for w, y in zip(x, g, strict=True) if not y).encode()).hexdigest()) for d, x, g in brute(rows, WORD.findall, 35))
    got = Counter(tuple(r) for r in remove_repeats(spark.createDataFrame(rows, SCHEMA), digest=True).collect())
    assert got == want
    assert sum(n for (_, _, removed, _), n in want.items() if removed) > 40


def test_factors_cover_what_is_removed(spark):
    rows = [r for r in corpus(2) if r[0] is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    texts = {r.k: WORD.findall(r.text or "") for r in df.select(F.xxhash64("doc_id", "text").alias("k"), "text").collect()}
    by_id = {r.doc_id: r.k for r in df.select("doc_id", F.xxhash64("doc_id", "text").alias("k")).collect()}
    seen = 0
    for r in remove_repeats(df).collect():
        assert sum(f.n for f in r.spans) == r.n_removed and all(f.n >= 35 for f in r.spans)
        words = next(texts[k] for d, k in by_id.items() if d == r.doc_id and len(texts[k]) == r.n_words) if r.doc_id != 9 else None
        covered = set()
        for f in r.factors:
            covered |= set(range(f.lo, f.lo + f.n))
            if words is not None:
                # a factor is the same words in its reference, at another place
                assert texts[f.source][f.source_lo : f.source_lo + f.n] == words[f.lo : f.lo + f.n] and f.n >= 35
                assert f.source != by_id[r.doc_id] or f.source_lo != f.lo or r.doc_id == 7
                seen += 1
        assert len(covered) == r.n_removed
    assert seen > 40
    for r in remove_repeats(df).collect():
        assert len(WORD.findall(r.kept_text)) == r.n_words - r.n_removed


def test_bytes_match_brute_force(spark):
    for most in (32, 2):
        rows = corpus(3)
        want = Counter((d, len(x), sum(g), sum(g[i] and not (i and g[i - 1]) for i in range(len(g))), hashlib.sha256(bytes(w for w, y in zip(x, g, strict=True) if not y)).hexdigest()) for d, x, g in brute(rows, lambda t: list(t.encode()), 100))
        got = Counter(tuple(r) for r in remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA), window=100, anchor=40, block_spans=most, digest=True).collect())
        assert got == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert remove_repeats(empty).count() == 0 and remove_repeated_bytes(empty).count() == 0


def test_suffix_array_matches_sorting():
    r = random.Random(5)
    for n in [0, 1, 2, 3, 5, 30, 200, 1500]:
        for letters in (1, 2, 3, 20):
            text = [r.randrange(letters) for _ in range(n)]
            assert suffix_array(text) == sorted(range(n), key=lambda i: text[i:])


def test_repeated_starts():
    assert [x.tolist() for x in repeated_starts([b"abcabd", b"xabc"], 3)] == [[0], [1]]


def thue_morse():
    """Two texts of 1,024 letters that agree under every polynomial hash modulo 2^64."""
    one = "a"
    while len(one) < 1024:
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_thue_morse_texts_are_told_apart(spark):
    one, other = thue_morse()
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{rest} {one}", 1, "x"), (2, f"{rest} {other}", 1, "x")]
    assert {r.n_removed for r in remove_repeats(spark.createDataFrame(rows, SCHEMA), digest=True).collect()} == {0}
    rows = [(1, one, 1, "x"), (2, other, 1, "x")]
    assert {r.n_removed for r in remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA), window=1024, anchor=160).collect()} == {0}


def test_very_long_text(spark):
    words = [f"w{(i * 7919) % 90001}" for i in range(120_000)]
    words[100_000:100_060] = words[5:65]
    got = remove_repeats(spark.createDataFrame([(1, " ".join(words), 1, "x")], SCHEMA), digest=True).first()
    assert got.n_words == 120_000 and got.n_removed >= 120
    want = brute([(1, " ".join(words))], WORD.findall, 35)[0]
    assert got.n_removed == sum(want[2])
