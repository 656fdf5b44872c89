"""Document fingerprints by a homomorphic multiset hash (operator 1), with DataFrame functions only.

A paragraph (a line of the text) is hashed to a wide vector: IDENTITY lanes from XXH64 of the whole paragraph under
different seeds, and SKETCH lanes that count, for each bit of a hash, how many of the paragraph's phrases have it set. The
fingerprint of a text is the sum of its paragraphs' vectors, lane by lane modulo a power of two. So it does not depend on the
order of paragraphs, and inserting or deleting a paragraph adds or subtracts its vector (`combine`). Equal multisets of
paragraphs have equal fingerprints; the sketch lanes estimate how many phrases two texts share.

Sketch lanes are packed three to a long, 20 bits each, and a packed long is summed modulo 2^62: a lane that passes 2^20 carries
into the next, which blurs the likeness of texts of over a million phrases but not the homomorphism.

Defined results: null and empty texts are one empty paragraph; two texts without phrases are alike (1) if their
fingerprints are equal, else 0. Rows with one doc_id are ordered by a hash of the text; a null doc_id comes after all others.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = 8
PACKED = 20
FIELD = 20
#: One bit for each of the three lanes in a packed long.
ONES = sum(1 << (FIELD * i) for i in range(3))
LANE = (1 << FIELD) - 1
WRAP = (1 << 62) - 1
WIDE = (1 << 32) - 1
PHRASE = "(?<=[es.,;:!?|%#*&$])[\\x20\\x09-\\x0D]+"


def _phrases(paragraph: Column) -> Column:
    """Hashes of a paragraph's phrases: words up to one that ends in e, s or a mark, so that a cut depends on its place only."""
    return F.transform(F.filter(F.split(paragraph, PHRASE), lambda x: x != ""), lambda x: F.xxhash64(x))


def fingerprint(text: Column) -> Column:
    """array<long>: IDENTITY sums modulo 2^32, the number of phrases, PACKED sums modulo 2^62."""
    paragraphs = F.split(F.coalesce(text, F.lit("")), "\n")
    phrases = F.flatten(F.transform(paragraphs, _phrases))

    def summed(i: int) -> Column:
        return F.aggregate(paragraphs, F.lit(0).cast("long"), lambda acc, p: (acc + F.xxhash64(p, F.lit(i)).bitwiseAND(F.lit(WIDE))).bitwiseAND(F.lit(WIDE)))

    identity = [summed(i) for i in range(IDENTITY)]

    def lanes(h: Column) -> list[Column]:
        return [F.shiftrightunsigned(h, i).bitwiseAND(F.lit(ONES)) for i in range(PACKED)]

    names = [f"s{i}" for i in range(PACKED)]
    zero = F.struct(*[F.lit(0).cast("long").alias(x) for x in names])
    sums = F.aggregate(phrases, zero, lambda acc, h: F.struct(*[(acc[x] + y).bitwiseAND(F.lit(WRAP)).alias(x) for x, y in zip(names, lanes(h), strict=True)]), lambda acc: F.array(*[acc[x] for x in names]))
    return F.concat(F.array(*identity, F.size(phrases).cast("long")), sums)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets of paragraphs together; sign -1 takes b's away from a's."""
    masks = F.array(*[F.lit(WIDE)] * IDENTITY, F.lit(WRAP), *[F.lit(WRAP)] * PACKED)
    return F.zip_with(F.zip_with(a, b, lambda x, y: x + (y if sign > 0 else -y)), masks, lambda x, m: x.bitwiseAND(m))


def text_of(fp: Column) -> Column:
    """Lowercase hex, 16 digits a lane."""
    return F.lower(F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _signed(fp: Column) -> Column:
    """The sketch: for each bit, the phrases that have it set less those that do not."""
    packed = F.slice(fp, IDENTITY + 2, PACKED)
    lanes = F.flatten(F.transform(packed, lambda x: F.array(*[F.shiftright(x, FIELD * j).bitwiseAND(F.lit(LANE)) for j in range(3)])))
    return F.transform(lanes, lambda x: (2 * x - F.element_at(fp, IDENTITY + 1)).cast("double"))


def _square(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints; else 2<x,y> / (<x,x> + <y,y>) of the texts' phrase counts, as the sketches estimate it."""
    x, y = _signed(a), _signed(b)
    near = 1 - F.try_divide(_square(F.zip_with(x, y, lambda u, v: u - v)), _square(x) + _square(y))
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(near, F.lit(0.0)))))


def with_next(docs: DataFrame, fields: dict[str, Column], parts: int) -> DataFrame:
    """doc_id, text and the fields, and next_text and next_<field> of the next row by descending doc_id (after the last: the
    first).

    Rows are ordered by (doc_id, hash of the text) and cut into about `parts` ranges of that; a doc_id with more rows than a
    range holds is cut by the hash. Each range is ordered by itself; its highest row also stands, as a guest, at the end of
    the range above it. So no task orders more than a range, but for rows that are equal. The driver sees a few numbers a range.
    """
    spark = docs.sparkSession
    low = F.lit(-(1 << 63)).cast("long")
    ids = docs.select(F.coalesce("doc_id", low).alias("sid"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    found = ids.agg(F.percentile_approx("sid", [i / parts for i in range(1, parts)], max(10_000, 20 * parts))).first()[0] if parts > 1 else []
    shares = Counter(found or [])
    cuts = sorted(shares)
    # the number of cuts below an id, found in two steps of about sqrt(parts)
    step = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    numbers = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])

    def range_of(sid: Column, h: Column) -> Column:
        if not cuts:
            return F.lit(0).cast("long")
        block = F.size(F.filter(numbers(b[-1] for b in blocks), lambda x: x < sid))
        inner = F.element_at(F.array(*[numbers(b) for b in blocks]), F.least(block + 1, F.lit(len(blocks))))
        below = F.when(block < len(blocks), block * step + F.size(F.filter(inner, lambda x: x < sid))).otherwise(len(cuts)).cast("long")
        if max(shares.values()) == 1:
            return below
        # a doc_id that several cuts fall on gets as many ranges, by its texts' hashes
        several = {c: n for c, n in shares.items() if n > 1}
        n = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x).cast("long") for kv in several.items() for x in kv]), sid), F.lit(0))
        sub = F.when(n > 0, 1 + F.floor((F.shiftright(h, 33) + (1 << 30)) * n / float(1 << 31))).otherwise(0)
        return below * (max(several.values()) + 2) + sub.cast("long")

    heads = {r.part: r.head for r in ids.groupBy(range_of(F.col("sid"), F.col("h")).alias("part")).agg(F.max(F.struct("sid", "h")).alias("head")).collect()}
    held = sorted(heads)
    table = [(p, heads[p].sid, heads[p].h, held[(i + 1) % len(held)]) for i, p in enumerate(held)]
    # a row a range
    ends = spark.createDataFrame(table, "part long, head_sid long, head_h long, above long")
    rows = docs.select(F.coalesce("doc_id", low).alias("sid"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", F.xxhash64("text").alias("h")).select("*", range_of(F.col("sid"), F.col("h")).alias("part"), *[c.alias(n) for n, c in fields.items()])
    rows = rows.join(F.broadcast(ends), "part")
    own, guest = (F.struct(F.col(c).alias("at"), F.lit(g).alias("guest")) for c, g in (("part", 0), ("above", 1)))
    highest = (F.col("sid") == F.col("head_sid")) & (F.col("h") == F.col("head_h"))
    rows = rows.select("*", F.explode(F.when(highest, F.array(own, guest)).otherwise(F.array(own))).alias("place"))
    order = Window.partitionBy("place.at").orderBy("place.guest", F.desc("sid"), F.desc("h"))
    names = ["text", *fields]
    return rows.select("*", *[F.lead(n).over(order).alias(f"next_{n}") for n in names]).filter("place.guest = 0").select("doc_id", *names, *[f"next_{n}" for n in names])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fp of each text (null: empty)."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select("doc_id", F.char_length(text).cast("long").alias("n_chars"), fingerprint(text).alias("fp"))


def edits(docs: DataFrame) -> DataFrame:
    """Each text against its edited text, whose second half is the start of the next document, and against that document."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs, {"fp": fingerprint(F.col("text"))}, parts)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    rows = rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "fp", fingerprint(F.col("edited")).alias("edited_fp"), "next_fp")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of(F.col("fp")).alias("fingerprint"),
        text_of(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
