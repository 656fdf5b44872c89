import random

import public_tokenizers
import sentencepiece

from locusframe.llm.pieces import Pieces, decode, digests, encode, encode_words, frequent_words, merge

SCHEMA = "doc_id long, text string, ids string, own0 int"
SP = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def texts():
    r = random.Random(6)
    words = "the of and athe thing Eauouon été übersicht ciónes señor 日本語 \U0001f600 don't x1.2 www.example.com AAAA <0x0A> </s>".split()
    out = [None, "", " ", "  two  spaces ", "line\none\n\n\ttab \r\n x", "a" * 700, "ab " * 50, "日本" * 300, "<unk> <s> <0x41>"]
    return out + ["".join(r.choice(words) + r.choice([" ", " ", "  ", "\n", ", "]) for _ in range(r.randint(1, 80))) for _ in range(40)]


def test_encoding_is_the_librarys_and_comes_back(spark):
    pieces = Pieces.load()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts())], SCHEMA)
    for dictionary in (0, 20):
        got = {r.doc_id: r.ids for r in encode(df, pieces, dictionary).collect()}
        assert got == {i: SP.encode(t or "") for i, t in enumerate(texts())}
    back = {r.doc_id: r.text for r in decode(encode(df, pieces, 20), pieces).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts())}
    assert all(r.round_trip and r.n_tokens == len(SP.encode(texts()[r.doc_id] or "")) for r in digests(df, pieces, 20).collect())


def test_relational_words_match_merging(spark):
    pieces = Pieces.load()
    r = random.Random(2)
    words = {"▁" + "".join(r.choice("abcdeinorstuéü日\U0001f600") for _ in range(r.randint(1, 14))) for _ in range(150)} | {"\n", "▁", "▁▁▁", "▁the", "▁Eauouon"}
    got = {x.word: x.ids for x in encode_words(spark.createDataFrame([(w,) for w in words], "word string"), pieces).collect()}
    assert got == {w: merge(w, pieces.table(), pieces.byte_ids) for w in words}


def test_frequent_words_are_the_most_frequent(spark):
    text = " ".join(w for i, w in enumerate("one two three four five six seven eight".split()) for _ in range(2**i)) + " " + "x" * 80 + " " + "x" * 80
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert {r.word for r in frequent_words(df, 3).collect()} == {"▁six", "▁seven", "▁eight"}
    assert frequent_words(df, 0).count() == 0 and frequent_words(df, 100).count() == 7 and frequent_words(df.limit(0), 5).count() == 0


def test_very_long_texts_repeated_rows_and_null_ids(spark):
    pieces = Pieces.load()
    long = " ".join(f"word{i % 977}" for i in range(120_000)) + "y" * 20_000
    df = spark.createDataFrame([(1, long, "x", 1), (None, "again and again", "x", 1), (None, "again and again", "x", 1)], SCHEMA)
    got = digests(df, pieces).collect()
    assert len(got) == 3 and all(r.round_trip for r in got) and sum(r.doc_id is None for r in got) == 2
    assert next(r for r in got if r.doc_id == 1).n_tokens == len(SP.encode(long))


def test_mark_in_text_and_empty_table(spark):
    pieces = Pieces.load()
    df = spark.createDataFrame([(1, "a▁b", "x", 1)], SCHEMA)
    r = digests(df, pieces, 4).first()
    assert not r.round_trip and encode(df, pieces, 4).first().ids == SP.encode("a▁b")
    assert digests(df.limit(0), pieces, 4).count() == 0
