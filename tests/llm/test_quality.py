import re
from collections import Counter

import pytest

from locusframe.llm.quality import LIMITS, assess, keep_good
from test_repeats import corpus, thue_morse

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or "")}
    seen, dup, dup_chars, all_chars = set(), 0, 0, 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            all_chars += len(line)
            if line in seen:
                dup += 1
                dup_chars += len(line)
            seen.add(line)
    out |= {"n_dup_lines": dup, "dup_line_chars": dup_chars / max(all_chars, 1)}
    shares = []
    for n in LIMITS:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        hit = [False] * len(words)
        for i, g in enumerate(grams):
            if count[g] > 1:
                hit[i : i + n] = [True] * n
        if n == 3:
            out["n_repeat_words"] = sum(hit)
        shares.append(sum(len(w) for w, h in zip(words, hit, strict=True) if h) / max(out["word_chars"], 1))
    out["coverage"] = shares
    out["kept"] = all(c <= limit for c, limit in zip(shares, LIMITS.values(), strict=True)) and out["dup_line_chars"] <= 0.3 and out["n_symbols"] <= 0.05 * max(out["word_chars"], 1)
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    return out


def rows():
    own = [(200 + i, t, 2, "y") for i, t in enumerate(["é# ü\nx\nx\n\nx \nx", "a b c a b c", "l one\n" * 40, "日本 語\t" * 60, "\n", "a|b <c> " * 3, " ".join(f"w{i}###" for i in range(60)), " ".join(f"word{i}" for i in range(60))])]
    return corpus(4) + own


def test_measures_match_brute_force(spark):
    data = rows()
    got = assess(spark.createDataFrame(data, "doc_id long, text string, rid int, anchor string").coalesce(1)).collect()
    assert len(got) == len(data)
    want = sorted(((d, t) for d, t, *_ in data), key=str)
    by = {}
    for d, t, *_ in data:
        by.setdefault(d, []).append(brute(t))
    for r in got:
        w = next(x for x in by[r.doc_id] if x["n_words"] == r.n_words and x["word_chars"] == r.word_chars)
        for k in ("n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"):
            assert r[k] == w[k], (k, r, w)
        assert r.coverage == pytest.approx(w["coverage"]) and r.dup_line_chars == pytest.approx(w["dup_line_chars"])
        assert r.kept == (w["kept"] and not w["base_failed"])
    assert want


def test_keep_good_keeps_columns(spark):
    df = spark.createDataFrame([(1, "one two " * 40, "a", 3), (2, " ".join(f"w{i}" for i in range(60)), "b", None), (3, None, "c", 1)], "doc_id long, text string, kept string, n_words int")
    out = keep_good(df).collect()
    assert [r.doc_id for r in out] == [2] and out[0].kept == "b"
    assert keep_good(df.limit(0)).count() == 0 and assess(df.limit(0)).count() == 0


def test_thue_morse_and_very_long(spark):
    one, other = thue_morse()
    text = f"{one} x y {one}x\n{other} x y {other}x\n{one}\n{other}"
    long = " ".join(f"w{i}" for i in range(150_000)) + "\nsame line here\nsame line here"
    rows = [(1, text, "a"), (2, long, "a"), (None, long, "b"), (None, long, "b")]
    got = sorted(assess(spark.createDataFrame(rows, "doc_id long, text string, kept string")).collect(), key=lambda r: r.n_words)
    assert (got[0].n_dup_lines, got[0].n_repeat_words) == (0, 0)
    assert all((r.n_words, r.n_dup_lines, r.n_repeat_words) == (150_006, 1, 6) for r in got[1:]) and len(got) == 4
