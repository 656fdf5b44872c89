import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from locusframe.llm import crosstok
from locusframe.llm.store import documents

DOCS = "doc_id long, text string, rid string, pairs int"


@pytest.fixture(scope="module")
def tokenizers():
    return crosstok.Tokenizers.load()


def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(texts):
    """Per text: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), by the libraries and all pairs of tokens."""
    lib_a, lib_b = libraries()
    letters = crosstok.byte_letters()
    names = {i: t for t, i in lib_a.get_vocab().items()}
    out, per, docs_of = [], [], Counter()
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = lib_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = lib_b.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in names[i]) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if lib_b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [lib_b.id_to_piece(i)]]
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            a, b, raw_a, raw_b = [], [], [], []
        end_a, end_b = np.cumsum([len(x) for x in raw_a] + [0])[:-1].tolist(), np.cumsum([len(x) for x in raw_b] + [0])[:-1].tolist()
        both = sorted(set(end_a) & set(end_b))
        group = lambda ends, ids, lo, hi: ",".join(str(i) for e, i in zip(ends, ids, strict=True) if lo < e <= hi)
        parts = [group(end_a, a, lo, hi) + "|" + group(end_b, b, lo, hi) for lo, hi in zip([0, *both], both, strict=False)]
        linked, j = [], 0
        for i in range(len(a)):
            lo, hi = end_a[i] - len(raw_a[i]), end_a[i]
            while j and end_b[j - 1] > lo:
                j -= 1
            while j < len(b) and end_b[j] <= lo:
                j += 1
            k = j
            while k < len(b) and end_b[k] - len(raw_b[k]) < hi:
                linked.append((a[i], b[k]))
                k += 1
        docs_of.update(set(linked))
        out.append([len(a), len(b), len(both), len(linked)])
        per.append((linked, hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    top = {}
    for (x, _), n in docs_of.items():
        top[x] = max(n, top.get(x, 0))
    return [(*o, sum(docs_of[p] == top[p[0]] for p in linked), sum(docs_of[p] for p in linked), sha) for o, (linked, sha) in zip(out, per, strict=True)]


def made_texts():
    r = random.Random(4)
    pool = ["the", "The", "Zürich", "naïve", "中文字", "🙂🙃", "don't", "<|endoftext|>", "<s>", "1234567", "\n\n", "\t", "   ", "!!!", "é́", "\x85", " ", "x" * 30, "\x00", "aaaaab"]
    texts = ["".join(r.choice(["", " ", " "]) + r.choice(pool) for _ in range(r.randint(1, 40))) for _ in range(120)]
    return [*texts, None, "", " ", "  ", "\n", "a", "▁ in it", "a▁b", *texts[:10], *["same again and again"] * 40]


@pytest.mark.parametrize("common", [1 << 18, 40, 0])
def test_equals_brute_force(spark, tokenizers, common, monkeypatch):
    monkeypatch.setattr(crosstok, "HELD", 500)
    texts = made_texts()
    rows = [(i if i % 17 else None, t, "r", 0) for i, t in enumerate(texts)]
    got = crosstok.align(spark.createDataFrame(rows, DOCS), tokenizers, common).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((row[0], *w) for row, w in zip(rows, brute(texts), strict=True)), key=str)


def test_equals_brute_force_on_documents(spark, tokenizers):
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in crosstok.align(docs, tokenizers, 5000).collect()}
    assert got == dict(zip([r.doc_id for r in rows], brute([r.text for r in rows]), strict=True))


def test_long_texts_are_aligned_in_stretches(tokenizers, monkeypatch):
    r = random.Random(9)
    texts = [" ".join(r.choice(["alpha", "Béta", "gamma3", "中文", "\n"]) for _ in range(3000)), "short one", " " * 300_000 + "x", "y" * 200_000]
    enc = tokenizers.encoders()
    whole = crosstok.aligned(enc, texts, len(tokenizers.raw_b))
    monkeypatch.setattr(crosstok, "STRETCH", 64)
    parts = crosstok.aligned(enc, texts, len(tokenizers.raw_b))
    for x, y in zip(whole, parts, strict=True):
        assert np.array_equal(np.array(x), np.array(y))
    assert whole[0][0].min() > 0


def test_both_libraries_of_side_a_give_the_same_ids(tokenizers):
    enc, (slow, _) = tokenizers.encoders(), libraries()
    letters = [chr(c) for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b 1{c}{c}2  {c} .{c}! {c}" for c in letters] + [" " + t for t in made_texts() if t]
    assert [enc.a(t).tolist() for t in texts] == [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]


def test_empty_table(spark, tokenizers):
    assert crosstok.align(spark.createDataFrame([], DOCS), tokenizers).collect() == []
