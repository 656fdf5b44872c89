"""PII by information-theoretic sanitisation (operator 4), with DataFrame functions only.

Base: emails, IP addresses, card and phone numbers by pattern and checksum. Each value found is a protected entity. The
method adds the terms that would reveal one. Over the documents of the corpus, n(t) hold a term t, and n(e, t) hold it beside
an entity e: in one line (of a line over CONTEXT characters, in one stretch that ends before white space). Seeing t tells
PMI(e, t) of the -log2 p(e) bits that naming e would, and leaves -log2 p(e | t). p(e | t) is taken from below, as the Wilson
bound of n(e, t) of n(t) at SURE standard deviations, so that what is left grows as evidence shrinks: with the defaults a
term has to stand beside e in two documents at least, and in hardly any without. A term that leaves at most `leftover` bits of some
entity, and tells a bit of it at least (an entity of a third of all documents is no secret), is revealing. Revealing terms are
generalised wherever they stand, in the entity's line or not, in its document or not. What a base pattern matches is no term.

The terms' counts over the corpus are a plain grouped count. Where revealing terms stand is found by joining words to them:
all words of the texts that hold entities; of the other texts, only to those terms that occur without any entity.

Positions are code points. A pattern's matches come from regexp_extract_all and the gaps between them from split, so ends
follow from running sums of lengths, taken CHUNK matches at a time so that texts with many matches take linear time. Patterns
start only where no match could have started earlier in a run of their characters (or where the last match ended) and use
possessive repeats, so that long runs take linear time; what they match is the same. No match holds a line break.

Defined results: null and empty texts have no spans; base spans of different kinds may overlap; a term that begins inside a
base span is left out; the rewritten text replaces the union of all spans, naming the kind that starts first; rows with equal
doc_id and text get equal spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.store import written

EMAIL = "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
TERM = "[\\p{L}\\p{N}_]{4,}"
#: The longest context, in characters.
CONTEXT = 2000
_STRETCH = f"[^\\n]{{1,{CONTEXT}}}(?=[\\n\\x20\\t]|$)|[^\\n]{{{CONTEXT}}}"
CHUNK = 256


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.char_length(digits))
    values = F.transform(places, lambda i: (F.ascii(F.substring(digits, -i, F.lit(1))) - 48) * F.when(i % 2 == 1, 1).otherwise(2))
    return F.aggregate(values, F.lit(0), lambda acc, v: acc + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _let(x: Column, f) -> Column:
    """f(x) with x evaluated once: what stands in a lambda function would be evaluated at each of its calls."""
    return F.transform(F.array(x), f)[0]


def _scan(items: Column, kind: str, step) -> Column:
    """Fold an array to another one: step(at, x) gives (the next at, an array of what x adds), at being an int from 0.

    Arrays are copied when they grow, so the fold fills one for each CHUNK items and joins those in the end.
    """
    none = F.array().cast(kind)

    def one(acc: Column, x: Column) -> Column:
        at, more = step(acc["at"], x)
        return F.struct(at.cast("int").alias("at"), F.concat(acc["out"], more).alias("out"))

    def folded(held: Column) -> Column:
        def chunk(acc: Column, begin: Column) -> Column:
            done = lambda a: F.struct(a["at"].alias("at"), F.concat(acc["out"], F.array(a["out"])).alias("out"))
            return F.aggregate(F.slice(held, begin + 1, F.lit(CHUNK)), F.struct(acc["at"].alias("at"), none.alias("out")), one, done)

        chunks = F.when(F.size(held) > 0, F.sequence(F.lit(0), F.size(held) - 1, F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out")), chunk, lambda a: a["out"])

    return F.flatten(_let(items, folded))


def _matches(text: Column, pattern: str, kind: int, valid) -> Column:
    """Every match as (start, kind, end, value), failing ones dropped."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = _let(found, lambda m: F.arrays_zip(m.alias("m"), F.slice(gaps, F.lit(1), F.size(m)).alias("g")))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        begin = at + F.char_length(x["g"])
        end = begin + F.char_length(x["m"])
        return end, F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("value")))

    return F.filter(_scan(pairs, SPAN, step), lambda s: valid(s["value"]))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end, value>> of a text that is not null, by start, then kind."""
    none = F.array().cast(SPAN)
    small = lambda v: F.forall(F.split(v, "\\."), lambda p: F.char_length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(F.split(v, "\\."), lambda p: F.substring(F.concat(F.lit("000"), F.regexp_replace(p, "^0+", "")), -3, 3) <= "255")
    card = lambda v: F.char_length(_digits(v)).between(14, 19) & _luhn(_digits(v))
    phone = lambda v: F.char_length(_digits(v)).between(10, 15)
    has = lambda p: text.rlike(p)
    return F.array_sort(
        F.concat(
            F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL, 0, lambda v: F.lit(True))).otherwise(none),
            F.when(has("[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]"), _matches(text, IP, 1, small)).otherwise(none),
            F.when(has("[0-9](?:[\\x20-]?[0-9]){13}"), _matches(text, CARD, 2, card)).otherwise(none),
            F.when(has("\\+[0-9]"), _matches(text, PHONE, 3, phone)).otherwise(none),
        )
    )


def found(docs: DataFrame) -> DataFrame:
    """doc_id, rid (a hash of doc_id and text), text (null: empty), spans."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("spans", base_spans(F.col("text")))


def _terms(text: Column) -> Column:
    """The different terms of a text, without what the base patterns match."""
    blank = F.when(text.rlike("@|[0-9]{2}"), F.regexp_replace(text, "|".join((EMAIL, PHONE, CARD, IP)), " ")).otherwise(text)
    return F.array_distinct(F.regexp_extract_all(F.lower(blank), F.lit(TERM), F.lit(0)))


def _contexts(text: Column) -> Column:
    return F.explode(F.regexp_extract_all(text, F.lit(_STRETCH), F.lit(0)))


#: Standard deviations between a share that was counted and the one that is relied on.
SURE = 0.9


def at_least(part: Column, of: Column, sure: float = SURE) -> Column:
    """The lower Wilson bound of a share."""
    p, n, z = part / of, of.cast("double"), sure * sure
    return (p + z / (2 * n) - sure * F.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)


def revealing_terms(docs: DataFrame, holding: DataFrame, leftover: float = 0.5) -> DataFrame:
    """term, n_et, bits (left of the entity that it tells most of), stray (documents without any entity hold it too).

    docs: every text; holding: row, text of those with entities.
    """
    beside = holding.select("row", _contexts(F.col("text")).alias("context"))
    beside = beside.select("row", "context", F.array_distinct(F.transform(base_spans(F.col("context")), lambda s: F.concat_ws(":", s["kind"].cast("string"), s["value"]))).alias("entities")).filter(F.size("entities") > 0)
    lines = written(beside.select("row", _terms(F.col("context")).alias("terms"), "entities"), "entity-lines")
    # documents that hold each entity: one document makes no evidence, and of a frequent entity nothing is told
    held = lines.select("row", F.explode("entities").alias("entity")).distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    told = held.filter((F.col("n_e") > 1) & (F.col("n_e") <= docs.count() * 2 ** -(leftover + 1))).select("entity")
    pairs = lines.select("row", "terms", F.explode("entities").alias("entity")).join(told, "entity").select("row", "entity", F.explode("terms").alias("term")).distinct()
    best = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et")).filter("n_et > 1").groupBy("term").agg(F.max("n_et").alias("n_et"))
    here = holding.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_here"))

    def left(n_t: str) -> Column:
        return -F.log2(at_least(F.col("n_et"), F.col(n_t)))

    # the documents with entities bound a term's count from below, which settles most terms
    hopeful = written(best.join(here, "term").filter(left("n_here") <= leftover), "hopeful-terms")
    counts = docs.select(F.explode(_terms(F.coalesce("text", F.lit("")))).alias("term")).join(hopeful.select("term"), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    return hopeful.join(counts, "term").filter(left("n_t") <= leftover).select("term", "n_et", left("n_t").alias("bits"), (F.col("n_t") > F.col("n_here")).alias("stray"))


def term_spans(docs: DataFrame, leftover: float = 0.5) -> DataFrame:
    """rid, terms: spans of kind `term`, by start."""
    rows = found(docs)
    # a number for each row, fixed by writing it
    holding = written(rows.filter(F.size("spans") > 0).select(F.monotonically_increasing_id().alias("row"), "rid", "text"), "entity-texts")
    revealing = written(revealing_terms(docs, holding, leftover), "revealing-terms")
    others = docs.select(F.xxhash64("doc_id", "text").alias("rid"), F.coalesce("text", F.lit("")).alias("text"))
    words = others.select("rid", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    astray = words.join(revealing.filter("stray").select("term"), "term", "left_semi").select("rid").distinct()
    astray = astray.join(holding.select("rid"), "rid", "left_anti")
    texts = holding.select("rid", "text").unionByName(others.join(astray, "rid", "left_semi"))
    tokens = texts.select("rid", F.explode(_matches(F.col("text"), TERM, 4, lambda v: F.lit(True))).alias("s")).withColumn("term", F.lower("s.value"))
    hits = tokens.join(revealing.select("term"), "term", "left_semi")
    return written(hits.groupBy("rid").agg(F.array_sort(F.collect_set("s")).alias("terms")), "term-spans")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _all_spans(base: DataFrame, terms: DataFrame) -> DataFrame:
    """base with `every`: its spans and the terms that begin outside them, by start, then kind."""
    rows = base.join(terms.withColumnRenamed("rid", "terms_rid"), F.col("rid") == F.col("terms_rid"), "left")

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        inside = (s["kind"] == 4) & (s["start"] < at)
        end = F.when(s["kind"] == 4, at).otherwise(F.greatest(at, s["end"]))
        return end, F.when(inside, F.array().cast(SPAN)).otherwise(F.array(s))

    merged = _scan(F.array_sort(F.concat("spans", "terms")), SPAN, step)
    return rows.withColumn("every", F.when(F.col("terms").isNull(), F.col("spans")).otherwise(merged))


def report(docs: DataFrame, leftover: float = 0.5) -> DataFrame:
    """doc_id, counts by kind, base_sha256, spans (kind:start:end by start, then kind, comma-joined), n_term, n_base."""
    terms = term_spans(docs, leftover)
    rows = _all_spans(found(docs).select("doc_id", "rid", "spans"), terms)
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts[:4], F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"), _joined(F.col("every")).alias("spans"), counts[4], F.size("spans").cast("long").alias("n_base"))


def _of_kind(k: int) -> Column:
    return F.filter("every", lambda s: s["kind"] == k)


def _rewritten(text: Column, spans: Column) -> Column:
    """text with the union of the spans (by start) replaced; CHUNK spans at a time, each time on the text that is left."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        # a span that begins in an earlier one only lengthens it: no gap, no tag
        end = F.greatest(at, s["end"])
        return end, F.array(F.struct(s["start"].alias("start"), F.when(s["start"] >= at, s["kind"]).otherwise(-1).alias("kind"), end.alias("end"), at.alias("before")))

    def chunk(acc: Column, mine: Column) -> Column:
        n = F.element_at(mine, -1)["end"] - acc["at"]

        def cut(block: Column) -> Column:
            gap = lambda s: F.substring(block, s["before"] - acc["at"] + 1, s["start"] - s["before"])
            return F.array_join(F.transform(mine, lambda s: F.when(s["kind"] >= 0, F.concat(gap(s), F.element_at(tags, s["kind"] + 1))).otherwise(F.lit(""))), "")

        rest = F.substring(acc["rest"], n + 1, F.char_length(acc["rest"]))
        return F.struct(F.element_at(mine, -1)["end"].alias("at"), rest.alias("rest"), F.concat(acc["out"], F.array(_let(F.substring(acc["rest"], F.lit(1), n), cut))).alias("out"))

    def folded(place: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), text.alias("rest"), F.array().cast("array<string>").alias("out"))
        chunks = F.transform(F.sequence(F.lit(0), F.size(place) - 1, F.lit(CHUNK)), lambda i: F.slice(place, i + 1, F.lit(CHUNK)))
        return F.aggregate(chunks, begin, chunk, lambda acc: F.concat(F.array_join(acc["out"], ""), acc["rest"]))

    return _let(_scan(spans, "array<struct<start:int,kind:int,end:int,before:int>>", step), folded)


def sanitise(docs: DataFrame, leftover: float = 0.5) -> DataFrame:
    """docs with every span of its texts replaced by its kind in brackets; n_chars, if there, follows. Null texts stay."""
    terms = term_spans(docs, leftover)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    rows = rows.select("doc", F.xxhash64("doc.doc_id", "doc.text").alias("rid"), F.coalesce("doc.text", F.lit("")).alias("text"))
    rows = _all_spans(rows.withColumn("spans", base_spans(F.col("text"))), terms)
    rows = rows.select("doc", F.when((F.size("every") == 0) | F.col("doc.text").isNull(), F.col("doc.text")).otherwise(_rewritten(F.col("text"), F.col("every"))).alias("clean"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("clean").alias(name)
        if name == "n_chars":
            return F.when(F.col("clean").isNull(), F.col("doc.n_chars")).otherwise(F.char_length("clean")).cast(docs.schema[name].dataType).alias(name)
        return F.col("doc").getField(name).alias(name)

    return rows.select(*[column(c) for c in docs.columns])
