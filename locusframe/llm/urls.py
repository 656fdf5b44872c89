"""URL filters by expressions and hash prefixes (operator 11).

A rule is a host, a path and a verdict; it fits its host and all subdomains if the URL's path starts with the rule's. A URL is
expanded into expressions, a suffix of its host's labels and a prefix of its path each; only suffixes of as many labels and
prefixes of as many characters as some rule has are made, so there are few and none is missing. Expressions meet rules by an
equal prefix of 32 bits of their SHA-256, then the full digests are compared; of the rules that are left the one of the longest
host wins, of those the one of the longest path, of those a block.

Rules up to `small` go to all tasks (they are counted first), and a page's matches are gathered by its number. More rules meet
the expressions by a shuffle; a prefix that many pages have is dealt out over SALTS parts, with as many copies of its rules.

Defined results: a null URL or one without `://` has an empty host and path and fits no rule, unless a rule has both empty; a
URL that no rule fits gets the verdict `otherwise`; repeated rows are judged alike, each on its own; an empty table gives an
empty result; further columns are ignored. Rules with a null part or of more than LONGEST characters are errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.store import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Characters of a rule's host or path; so the shapes of rules that the driver sees are bounded.
LONGEST = 2048
#: Rules that go to all tasks; more are shuffled.
SMALL = 10_000
SALTS = 32
#: A prefix is dealt out if it has more than this part of all expressions.
HOT = 1 / 1024


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hashed(host: Column, path: Column) -> Column:
    """(prefix, digest) of an expression. A host has no `/`, `?` or `#`, so a zero byte tells where the path begins."""
    digest = F.sha2(F.concat(host, F.lit("\0"), path), 256)
    return F.struct(F.substring(digest, 1, 8).alias("prefix"), digest.alias("digest"))


def rule_table(rules: DataFrame) -> DataFrame:
    """prefix, digest, rule (host and path), verdict, rank, labels, chars of rules (host, path, verdict)."""
    bad = F.col("host").isNull() | F.col("path").isNull() | F.col("verdict").isNull() | (F.char_length("host") > LONGEST) | (F.char_length("path") > LONGEST)
    if rules.filter(bad).limit(1).count():
        raise ValueError(f"a rule needs a host, a path and a verdict, of {LONGEST} characters at most")
    host = F.translate("host", UPPER, UPPER.lower())
    h = _hashed(host, F.col("path"))
    # compared as a struct: longest host, longest path, block before the rest
    rank = F.struct(F.char_length("host").alias("host"), F.char_length("path").alias("path"), (F.col("verdict") == "block").alias("block"))
    return rules.select(h["prefix"].alias("prefix"), h["digest"].alias("digest"), F.concat(host, "path").alias("rule"), "verdict", rank.alias("rank"), F.size(F.split("host", "\\.")).alias("labels"), F.char_length("path").alias("chars"))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """array of (prefix, digest): the expressions of a URL whose (labels, characters) are in shapes."""
    labels = F.split(host, "\\.", -1)
    made = []
    for n, chars in shapes:
        suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
        made.append(F.when((F.size(labels) >= n) & (F.char_length(path) >= chars), _hashed(suffix, F.substring(path, 1, chars))))
    return F.array_compact(F.array(*made)) if made else F.array().cast("array<struct<prefix:string,digest:string>>")


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", url: str = "url", keep: tuple[str, ...] = ("page_id",), small: int = SMALL) -> DataFrame:
    """keep, host, path, rule (host and path of the winning rule, else null), verdict of every row of pages."""
    table = rule_table(rules)
    table = table.groupBy("prefix", "digest", "rule").agg(F.max(F.struct("rank", "verdict")).alias("best"), F.first("labels").alias("labels"), F.first("chars").alias("chars"))
    shapes = sorted((r.labels, r.chars) for r in table.select("labels", "chars").distinct().collect())
    table = table.select("prefix", F.col("digest").alias("full"), F.struct(F.col("best.rank").alias("rank"), "rule", F.col("best.verdict").alias("verdict")).alias("found"))
    rows = pages.select(F.struct(*keep).alias("own"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path")).withColumn("rid", F.monotonically_increasing_id())
    made = expressions(F.col("host"), F.col("path"), shapes)
    if table.count() <= small:
        met = rows.withColumn("e", F.explode_outer(made)).join(F.broadcast(table), F.col("e.prefix") == F.col("prefix"), "left")
        found = F.when(F.col("e.digest") == F.col("full"), F.col("found"))
        best = met.groupBy("rid").agg(*[F.first(c).alias(c) for c in ("own", "host", "path")], F.max(found).alias("found"))
    else:
        rows = written(rows, "urls")
        best = rows.join(_matched(rows.select("rid", F.explode(made).alias("e")).select("rid", "e.*"), table), "rid", "left")
    return best.select("own.*", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.lit(otherwise)).alias("verdict"))


def _matched(made: DataFrame, table: DataFrame) -> DataFrame:
    """rid, found: the winning rule of each row that has one."""
    counts = written(made.join(table.select("prefix").distinct(), "prefix", "left_semi").groupBy("prefix").agg(F.count(F.lit(1)).alias("n")), "url-prefixes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # at most 1 / HOT prefixes
    hot = F.broadcast(counts.filter(F.col("n") > total * HOT).select("prefix", F.lit(SALTS).alias("salts")))
    left = made.join(hot, "prefix", "left").withColumn("salt", F.pmod(F.xxhash64("rid"), F.coalesce("salts", F.lit(1))).cast("int"))
    right = table.join(hot, "prefix", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    met = left.select("rid", "prefix", "salt", "digest").join(right.select("prefix", "salt", "full", "found"), ["prefix", "salt"]).filter("digest = full")
    return met.groupBy("rid").agg(F.max("found").alias("found"))


ORACLE = """
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
  SELECT row_number() OVER () AS rid, page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
best AS (
  SELECT c.rid, arg_max(r.host || r.path, length(r.host) * 10000 + length(r.path)) AS rule, arg_max(r.verdict, length(r.host) * 10000 + length(r.path)) AS verdict
  FROM cut c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path) GROUP BY c.rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM cut LEFT JOIN best USING (rid)
"""
