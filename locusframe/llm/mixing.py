"""Mixing sources to target weights by a low-discrepancy schedule (operator 3).

The mix has as many words as the documents. Each source's target is its weight's share, at most `most` times its size; what
is over goes to the others by weight. A source's documents, shuffled by a hash, are laid end to end and cut into blocks of
equal size in words: about the mix's words by `slots`, but at least FINEST blocks a source, so that a small one comes near its
target too, however large the rest is. The mix is a sequence of slots, one a block. The golden ratio's multiples, modulo 1, are
spread evenly over [0, 1): slot i goes to the source under whose stretch of the cumulative targets, counted in blocks, its
point falls, so that every stretch of the mix has the sources in proportion. A slot's rank among its source's slots tells
which block it takes: they take blocks in order, again from the first after the last.

Ranks and running sums are taken in two steps (inside stretches of slots or hash buckets, then over their totals), so a source
with a third of all rows is no single task.

Defined results: null and empty texts have size 0 and are never taken; null is a source of its own, after all others; rows
with equal doc_id and text are documents of their own; without any word all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.store import written

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
GOLDEN = 0.6180339887498949
#: Blocks are as large as makes about this many slots, but a source has FINEST blocks at least (of a word at least).
SLOTS = 1 << 20
FINEST = 1 << 10
STRETCH = 1 << 12
#: At least so many hash buckets a source; more if the session deals its shuffles to more partitions.
BUCKETS = 1024


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, key (a hash for the shuffle), size."""
    key = F.md5(F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).cast("binary"))
    return docs.select("doc_id", "source", key.alias("key"), F.xxhash64("text").alias("h"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, slots: int = SLOTS) -> DataFrame:
    """source, rank (from 0), source_size, target, block (words), whole (the target in blocks), upto (whole up to and with this
    one). A row a source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    per = per.withColumn("full", most * F.col("source_size"))
    # sources fill up in the order of full / weight; before each, what is left and the weights that share it
    fill = Window.orderBy(F.col("full") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("total", F.sum("source_size").over(every)).withColumn("left", F.col("total") - F.coalesce(F.sum("full").over(before), F.lit(0)))
    per = per.withColumn("share", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    per = per.withColumn("rate", F.col("left").cast("double") / F.col("share")).withColumn("open", F.when(F.col("full") > F.col("rate") * F.col("weight"), F.col("rate")))
    # the first source that does not fill up sets the rate of all after it
    per = per.withColumn("held", F.first("open", ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    per = per.withColumn("target", F.coalesce(F.col("held") * F.col("weight"), F.col("full").cast("double")))
    even = F.ceil(F.col("total") / float(slots))
    per = per.withColumn("block", F.greatest(F.lit(1), F.least(even, F.ceil(F.col("source_size") / float(FINEST)))).cast("long"))
    per = per.withColumn("whole", F.round(F.col("target") / F.col("block")).cast("long"))
    upto = F.sum("whole").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per.withColumn("upto", upto).select("source", "rank", "source_size", "target", "block", "whole", "upto")


def schedule(plan: DataFrame) -> DataFrame:
    """slot, rank (of its source), nth (its place among the source's slots, from 0)."""
    spark = plan.sparkSession
    whole = plan.agg(F.max("upto")).first()[0] or 0
    slots = spark.range(whole).select(F.col("id").alias("slot"))
    point = (F.col("slot") + 0.5) * GOLDEN
    slots = slots.select("slot", F.floor((point - F.floor(point)) * whole).cast("long").alias("at"), F.floor(F.col("slot") / STRETCH).cast("long").alias("stretch"))
    bounds = plan.filter("whole > 0").select(F.col("rank"), (F.col("upto") - F.col("whole")).alias("lo"), F.col("upto").alias("hi"))
    # the few stretches of the targets are cut into equal cells, so that a slot meets them by an equal key
    cells = 4096
    cell = max(1, -(-whole // cells))
    pieces = bounds.select("rank", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell))).alias("cell"))
    found = slots.join(pieces, (F.floor(F.col("at") / cell) == F.col("cell")) & (F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi"))).select("slot", "stretch", "rank")
    counts = found.groupBy("rank", "stretch").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("rank", "stretch", F.coalesce(F.sum("n").over(Window.partitionBy("rank").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = found.withColumn("k", F.row_number().over(Window.partitionBy("rank", "stretch").orderBy("slot")))
    return ranked.join(counts, ["rank", "stretch"]).select("slot", "rank", (F.col("before") + F.col("k") - 1).alias("nth"))


def laid_out(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """sized with rank, source_size, target, block and lo, the words of its source before this document."""
    of = plan.select(F.col("source").alias("of"), "rank", "source_size", "target", "block")
    rows = sized.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    buckets = max(BUCKETS, 4 * int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / float(1 << 32)))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "h").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return rows.join(sums, ["rank", "bucket"]).withColumn("lo", F.col("before") + F.col("inner")).drop("before", "inner", "bucket")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, slots: int = SLOTS) -> DataFrame:
    """doc_id, source, h (a hash of the text), size, source_size, target, taken: words the mix takes, repeats counted."""
    sized = written(sizes(docs), "sizes")
    plan = written(targets(sized, weights, most, slots), "targets")
    placed = written(laid_out(sized, plan), "laid-out")
    blocks = F.ceil(F.col("source_size") / F.col("block")).cast("long")
    chosen = schedule(plan).join(plan.select("rank", blocks.alias("blocks")), "rank")
    # blocks run through the source in order, `most` times at most
    times = chosen.filter(F.col("nth") < most * F.col("blocks")).groupBy("rank", (F.col("nth") % F.col("blocks")).alias("number")).agg(F.count(F.lit(1)).alias("times"))
    block, end = F.col("block"), F.col("lo") + F.col("size")
    pieces = placed.filter("size > 0").select("rank", "lo", "size", "block", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((end - 1) / block))).alias("number"))
    words = F.least(end, (F.col("number") + 1) * block) - F.greatest(F.col("lo"), F.col("number") * block)
    taken = pieces.join(times, ["rank", "number"]).groupBy("rank", "lo").agg(F.sum(words * F.col("times")).cast("long").alias("taken"))
    # a document with words is known by its source and where it begins
    out = placed.join(taken.withColumnsRenamed({"rank": "r", "lo": "l"}), (F.col("rank") == F.col("r")) & (F.col("lo") == F.col("l")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "source", "h", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """The mix as rows of docs: a document as often as it is taken whole, and once more its first words if taken in part.

    A part keeps its words, joined by one space; n_chars, if docs has it, becomes that of the row's text. Rows that doc_id,
    text and source do not tell apart each take the mean of theirs, in whole words.
    """
    plan = mix(docs, weights, most).filter("taken > 0").groupBy("doc_id", "h", "source", "size").agg(F.floor(F.sum("taken") / F.count(F.lit(1))).alias("taken"))
    plan = plan.select(F.struct("doc_id", "h", "source", "size", "taken").alias("mix_plan"))
    m = F.col("mix_plan")
    # docs may have columns of any name: a row goes along as one struct
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.xxhash64(docs["text"]).alias("mix_h"))
    d = F.col("doc")
    rows = rows.join(plan, d["doc_id"].eqNullSafe(m["doc_id"]) & (F.col("mix_h") == m["h"]) & d["source"].eqNullSafe(m["source"]))
    part = (m["taken"] % m["size"]).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), F.floor(m["taken"] / m["size"]).cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    p = F.col("mix_part")
    text = F.when(p > 0, F.array_join(F.slice(F.regexp_extract_all(d["text"], F.lit(WORD), 0), F.lit(1), p), " ")).otherwise(d["text"])
    rows = rows.select("doc", F.explode(copies).alias("mix_part")).select("doc", text.alias("mix_text"))
    n_chars = F.char_length("mix_text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    own = {"text": F.col("mix_text"), "n_chars": n_chars}
    return rows.select(*[own.get(c, d[c]).alias(c) for c in docs.columns])


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source),
weighed AS (SELECT *, CAST([5, 2, 1][1 + rank % 3] AS BIGINT) AS weight, 3 * source_size AS full_size, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM per),
filling AS (
  SELECT *, CAST(total - coalesce(sum(full_size) OVER before, 0) AS DOUBLE) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS rate
  FROM weighed
  WINDOW before AS (ORDER BY CAST(full_size AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (
  SELECT *, first_value(CASE WHEN full_size > rate * weight THEN rate END IGNORE NULLS) OVER (ORDER BY CAST(full_size AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held
  FROM filling),
aimed AS (
  SELECT *, coalesce(held * weight, CAST(full_size AS DOUBLE)) AS target,
         greatest(1, least((total + 1048575) // 1048576, (source_size + 1023) // 1024)) AS block
  FROM opened),
plan AS (
  SELECT source, rank, source_size, target, block, CAST(round(target / CAST(block AS DOUBLE)) AS BIGINT) AS whole,
         CAST(sum(round(target / CAST(block AS DOUBLE))) OVER (ORDER BY rank) AS BIGINT) AS upto
  FROM aimed),
const AS (SELECT max(upto) AS whole FROM plan),
slots AS (
  SELECT slot, CAST(floor(((slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE - floor((slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE)) * whole) AS BIGINT) AS at
  FROM (SELECT unnest(range(whole)) AS slot, whole FROM const)),
found AS (
  SELECT p.rank, p.source_size, p.block, row_number() OVER (PARTITION BY p.rank ORDER BY slot) - 1 AS nth
  FROM slots ASOF JOIN (SELECT *, upto - whole AS lo FROM plan WHERE whole > 0) p ON slots.at >= p.lo),
times AS (
  SELECT rank, nth % ((source_size + block - 1) // block) AS block_no, count(*) AS times
  FROM found WHERE nth < 3 * ((source_size + block - 1) // block) GROUP BY ALL),
placed AS (
  SELECT s.*, p.rank, p.source_size, p.target, p.block,
         CAST(coalesce(sum(size) OVER (PARTITION BY p.rank ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lo
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
pieces AS (SELECT *, unnest(range(lo // block, (lo + size - 1) // block + 1)) AS block_no FROM placed WHERE size > 0),
taken AS (
  SELECT q.doc_id, CAST(sum((least(lo + size, (q.block_no + 1) * block) - greatest(lo, q.block_no * block)) * times) AS BIGINT) AS taken
  FROM pieces q JOIN times t ON q.rank = t.rank AND q.block_no = t.block_no GROUP BY q.doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM placed LEFT JOIN taken USING (doc_id)
"""
