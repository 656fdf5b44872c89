import hashlib
import math
import random
import re
import time
from collections import Counter

from locusframe.llm.pii import SURE, report, sanitise

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string, rid string, spans int"


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


TEXTS = [
    None,
    "",
    "mail a.b@c.de, é x_y@z.co.uk_q@r.st and @no.pe a@b a@b..c a..@b.c-d.e",
    "a@b.cd_e@f.gh%i@j.kl.",
    "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 1.2.3 010.000.0255.1 1.2.3.04 999.1.2.3.4.5 1.1.1.1a2.2.2.2",
    "card 4111 1111 1111 1111 4111-1111-1111-1112, 5500000000000004 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 4111 1111 1111 1111-",
    "call +1 (555) 123-4567 or +49 30 1234567890123 +12 +1-2 + 3 ü +33.1.23.45.67.89.",
    "ü " * 50 + "+1 4111 1111 1111 1111@x.yz 10.0.0.1@q.rs",
    "1 " * 30000 + "9" * 30000 + "." + "a" * 30000,
    "x@y.z\nsecond line p@q.r\n\n1.1.1.1",
]


def test_base_matches_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], SCHEMA)
    got = {r.doc_id: r for r in report(df).collect()}
    for i, t in enumerate(TEXTS):
        want = base(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, got[i].spans, want)
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(x.startswith(k) for x in want) for k in KINDS]
        assert set(want) <= set(got[i].spans.split(",")) or not want


def revealing(texts, leftover=0.5):
    """The terms that leave at most so many bits of some entity, and their spans in each text, by counting."""
    blank = re.compile("|".join(KINDS[k] for k in ("email", "phone", "card", "ip")))
    terms = lambda text: set(re.findall(r"\w{4,}", blank.sub(" ", text.lower())))
    n_t, n_et = Counter(), Counter()
    for text in texts:
        n_t.update(terms(text or ""))
        lines = (text or "").split("\n")
        n_et.update({(x.split(":")[0] + c[int(x.split(":")[1]) : int(x.split(":")[2])], t) for c in lines for x in base(c) for t in terms(c)})
    n_e = Counter(e for text in texts for e in {x.split(":")[0] + c[int(x.split(":")[1]) : int(x.split(":")[2])] for c in (text or "").split("\n") for x in base(c)})

    def least(k, n):
        z = SURE * SURE
        return (k / n + z / (2 * n) - SURE * math.sqrt(k / n * (1 - k / n) / n + z / (4 * n * n))) / (1 + z / n)

    told = {t for (e, t), n in n_et.items() if n > 1 and n_e[e] <= len(texts) * 2 ** -(leftover + 1) and -math.log2(least(n, n_t[t])) <= leftover}
    spans = []
    for t in texts:
        inside = [tuple(map(int, x.split(":")[1:])) for x in base(t)]
        spans.append([f"term:{m.start()}:{m.end()}" for m in re.finditer(r"\w{4,}", t or "") if m[0].lower() in told and not any(a <= m.start() < b for a, b in inside)])
    return told, spans


def test_revealing_terms_match_counting(spark):
    filler = [f"the day was number{i} and the sky was word{i % 7} with line{i}" for i in range(200)]
    told = [f"ask Zebulon about item{i} the mail is zeb@example.com\nZebulon lives in hamlet{i}\nand the weather was word{i % 7}" for i in range(8)]
    once = [f"Agnetha{i} and the number{i} call +1 (555) 123-45{i:02d}\nnothing\nthe weather of Agnetha{i}" for i in range(20)]
    texts = filler + told + once + ["Zebulon passed by once", "Agnetha3 elsewhere", None, "", "x@y.zz Agnetha7q x@y.zz"] + [told[0]] * 5
    terms, spans = revealing(texts)
    # once beside an entity is no evidence, five copies of a row are; what stands everywhere tells nothing
    assert "zebulon" in terms and "item0" in terms and not {"agnetha4", "item1", "weather"} & terms
    got = {x.doc_id: x for x in report(spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    for i, want in enumerate(spans):
        assert [x for x in got[i].spans.split(",") if x.startswith("term")] == want, texts[i]
        assert got[i].n_term == len(want) and got[i].n_base == len(base(texts[i]))
    assert any("Zebulon passed" in (t or "") and spans[i] for i, t in enumerate(texts))


def test_rewritten_text(spark):
    told = [f"ask Zebulon about item{i} the mail is zeb@example.com" for i in range(5)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(["the mail is about the weather", *told, *told, *[f"mail about other{i}" for i in range(30)]])], SCHEMA)
    out = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert out[0] == "the mail is about the weather" and out[1].startswith("ask [TERM] about item") | out[1].startswith("ask [TERM] about [TERM]") and out[1].endswith("[EMAIL]")
    assert df.columns == sanitise(df).columns


def test_many_spans_in_one_text(spark):
    text = "".join(f"a{i}@b.co é\n" for i in range(100_000)) + "x" * 50
    line = " ".join(f"a{i}@b.co" for i in range(20_000))
    began = time.time()
    rows = [(1, text, "x", 1), (2, line, "x", 1)]
    got = {r.doc_id: r for r in report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].n_email == 100_000 and got[2].n_email == 20_000
    assert got[2].base_sha256 == hashlib.sha256(",".join(base(line)).encode()).hexdigest()
    out = {r.doc_id: r.text for r in sanitise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[2] == " ".join(["[EMAIL]"] * 20_000) and out[1].startswith("[EMAIL] é\n[EMAIL]") and out[1].count("[EMAIL]") == 100_000
    assert time.time() - began < 120


def test_sanitise_overlaps_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None, "x", 1), (2, "é +49 30 1234567890@x.yz end", "x", 1)], SCHEMA)
    out = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert out[1] is None and out[2] == "é [PHONE] end"
    assert report(df.limit(0)).count() == 0 and sanitise(df.limit(0)).count() == 0


def test_planted_names_among_rare_words(spark):
    """Names that stand beside one address in 2 to 8 documents are found; words of one document, and of many, are not."""
    r = random.Random(11)
    words = [f"word{i}" for i in range(400)]
    texts, names = [f"{' '.join(r.choices(words, k=30))} rare{i}" for i in range(600)], []
    for k in range(40):
        name, n = "planted" + "".join(r.choices("abcdefgh", k=6)), r.randint(2, 8)
        names.append(name)
        texts += [f"{' '.join(r.choices(words, k=8))} {name} rarer{k}x{j} p{k}@mail.com\n{' '.join(r.choices(words, k=10))}" for j in range(n)]
        texts += [f"{name} {' '.join(r.choices(words, k=12))}"] * (n > 6)
    told, spans = revealing(texts)
    assert set(names) == told & set(names) and len(told - set(names)) <= 2
    got = {x.doc_id: x.spans for x in report(spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert all([x for x in got[i].split(",") if x.startswith("term")] == want for i, want in enumerate(spans))


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "call a@b.co", "x", 1)] * 3 + [(None, None, None, None), (4, "", "x", 1)]
    got = report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(x.n_email for x in got) == [0, 0, 1, 1, 1] and sum(x.doc_id is None for x in got) == 4
    assert sanitise(spark.createDataFrame(rows, SCHEMA)).count() == 5
