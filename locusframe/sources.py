"""Sources and sinks: call files, site matrices, alignments, intervals, edge lists, and the tables jobs keep between steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: The tables written by this process and not yet deleted.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session without one (tests) gets a new temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else None
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def _delete(spark: SparkSession, where: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> int:
    """Delete the tables that this process wrote; for when the results that read them have been used. Their number."""
    n = 0
    while _written:
        n += _delete(spark, _written.pop())
    return n


def discard(*tables: DataFrame) -> None:
    """Delete tables that `kept` returned, once what was made from them is kept itself."""
    for df in tables:
        _written.remove(df._kept_at)
        _delete(df.sparkSession, df._kept_at)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: short lineage that survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def call_lines(calls: DataFrame) -> DataFrame:
    """sample, value: calls as lines of tab-separated call files."""
    info = F.concat(F.lit("DP="), F.col("dp"), F.lit(";ADP="), F.col("adp"))
    fields = F.concat_ws(":", "gt", F.col("ad").cast("string"), F.col("rd").cast("string"))
    return calls.select("sample", F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), "ft", info, F.lit("GT:AD:RD"), fields).alias("value"))


def read_calls(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """contig, pos, sample, ref, alt, ft, info, format, value of call files (gzip or plain); sample from the path's
    `sample=` folder or file name; alleles longer than one letter or `*` become `n`."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths).withColumn("path", F.input_file_name()).filter("value not like '#%' and value <> ''")
    part = F.split("value", "\t")
    named = F.regexp_extract("path", "sample=([^/]+)/", 1)
    sample = F.when(named != "", named).otherwise(sample_name(F.regexp_extract("path", "([^/]+)$", 1)))
    one = lambda c: F.when((F.char_length(c) > 1) | (c == "*"), F.lit("n")).otherwise(c)
    return lines.select(part[0].alias("contig"), part[1].cast("long").alias("pos"), sample.alias("sample"), one(part[3]).alias("ref"), one(part[4]).alias("alt"), part[6].alias("ft"), part[7].alias("info"), part[8].alias("format"), part[9].alias("value"))


def unpack(calls: DataFrame) -> DataFrame:
    """info as a map with upper-case keys; fields as a map from format names to the sample's values."""
    info = F.transform_keys(F.str_to_map("info", F.lit(";"), F.lit("=")), lambda k, _: F.upper(k))
    return calls.withColumn("info", info).withColumn("fields", F.map_from_arrays(F.split("format", ":"), F.split("value", ":")))


def sample_name(name: Column, reference: str = "reference") -> Column:
    """A sample's name from a file name: the reference's suffix and known extensions go."""
    short = F.regexp_replace(name, "\\.(gz|bz2)$", "")
    short = F.regexp_replace(short, "\\.(vcf|bam|sam|fastq|fq|fasta|fa|html?|txt)$", "")
    short = F.regexp_replace(short, "\\.(sorted|cleaned|unique|shuffled|trimmed)$", "")
    return F.regexp_replace(short, f"-{reference}$", "")


def rename(df: DataFrame, column: str, pattern: str, into: str) -> DataFrame:
    """column changed by a regular expression; `collides` marks names that came from different ones."""
    new = df.select(F.col(column).alias("before")).distinct().withColumn("name", F.regexp_replace("before", pattern, into))
    clash = new.groupBy("name").agg((F.count(F.lit(1)) > 1).alias("collides"))
    return df.withColumn(column, F.regexp_replace(column, pattern, into)).join(clash.withColumnRenamed("name", column), column)


def read_intervals(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """contig, lo, hi of interval files of three columns, in any order of bounds; closed, 1-based."""
    raw = spark.read.csv(paths, sep="\t", schema="contig string, a long, b long")
    return raw.select("contig", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))


def alignment_to_long(alignment: DataFrame) -> DataFrame:
    """sample, pos (from 1), nt (upper case) of (sample, seq)."""
    letters = F.regexp_extract_all(F.upper("seq"), F.lit("(?s)."), F.lit(0))
    return alignment.filter("char_length(seq) > 0").select("sample", F.posexplode(letters)).select("sample", (F.col("pos") + 1).cast("long").alias("pos"), F.col("col").alias("nt"))


def flush(alignment: DataFrame) -> DataFrame:
    """least, most, flush: whether all sequences are of one length."""
    n = F.char_length("seq")
    return alignment.agg(F.min(n).cast("long").alias("least"), F.max(n).cast("long").alias("most")).withColumn("flush", F.col("least") == F.col("most"))


def clean_header(name: str) -> str:
    """A site matrix's column name without `#`, `[n]` and `:GT`."""
    return re.sub(r":GT$", "", re.sub(r"^\[\d+\]", "", name.lstrip("# ").strip()))


def write_matrix(matrix: DataFrame, path: str) -> None:
    """A wide site matrix (contig, pos, ref, samples) as tab-separated text, with numbered headers."""
    names = [f"[{i + 1}]{c}" + (":GT" if i > 2 else "") for i, c in enumerate(("CHROM", "POS", "REF", *matrix.columns[3:]))]
    matrix.toDF(*names).write.csv(path, sep="\t", header=True, quote="")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """contig, pos, ref, sample, nt of site matrices with headers as tools print them."""
    return matrix_to_long(spark.read.csv(path, sep="\t", header=True, quote=""))


def write_transposed(lines: DataFrame, path: str) -> None:
    """transposed_lines as tab-separated text."""
    lines.select(F.concat_ws("\t", "sample", "line")).write.text(path)


def read_transposed(spark: SparkSession, path: str) -> DataFrame:
    """sample, line."""
    return spark.read.text(path).select(F.substring_index("value", "\t", 1).alias("sample"), F.regexp_replace("value", "^[^\t]*\t?", "").alias("line"))


def write_fasta(alignment: DataFrame, path: str) -> None:
    """sample, seq as `>sample`, then the sequence on a line of its own."""
    alignment.select(F.concat(F.lit(">"), "sample", F.lit("\n"), "seq")).write.text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """sample, seq of FASTA files; a sequence may have several lines."""
    rows = spark.read.option("lineSep", ">").text(path).filter("value <> ''")
    return rows.select(F.substring_index("value", "\n", 1).alias("sample"), F.regexp_replace(F.regexp_replace("value", "^[^\n]*\n?", ""), "[\r\n]", "").alias("seq"))


def matrix_to_long(matrix: DataFrame) -> DataFrame:
    """contig, pos, ref, sample, nt of a wide site matrix with headers as tools print them."""
    named = matrix.toDF(*[clean_header(c) for c in matrix.columns])
    first = named.columns[:3]
    out = named.unpivot(first, named.columns[3:], "sample", "nt")
    return out.select(F.col(first[0]).alias("contig"), F.col(first[1]).cast("long").alias("pos"), F.col(first[2]).alias("ref"), "sample", "nt")


def transposed_lines(genotypes: DataFrame) -> DataFrame:
    """sample, line: a row for each sample under the header row `.`, of `contig:pos` names in order of contig and pos."""
    site = F.struct("contig", "pos", "value")
    head = genotypes.select("contig", "pos").distinct().select(F.lit(".").alias("sample"), "contig", "pos", F.concat_ws(":", "contig", F.col("pos").cast("string")).alias("value"))
    body = genotypes.select("sample", "contig", "pos", F.col("nt").alias("value"))
    rows = head.unionByName(body).groupBy("sample").agg(F.array_sort(F.collect_list(site)).alias("c"))
    return rows.select("sample", F.array_join(F.transform("c", lambda x: x["value"]), "\t").alias("line"))


def transposed_to_long(lines: DataFrame) -> DataFrame:
    """contig, pos, sample, nt of transposed_lines."""
    cells = lines.select("sample", F.posexplode(F.split("line", "\t")))
    head = cells.filter("sample = '.'").select("pos", F.col("col").alias("site"))
    body = cells.filter("sample <> '.'").withColumnRenamed("col", "nt")
    site = F.split("site", ":")
    return body.join(head, "pos").select(site[0].alias("contig"), site[1].cast("long").alias("pos"), "sample", "nt")


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge (a, b, d) and its reverse."""
    return edges.select("a", "b", "d").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))


def wide(genotypes: DataFrame, samples: list[str], missing: str = "N") -> DataFrame:
    """contig, pos, ref and a column for each sample: the first letter of its genotype."""
    out = genotypes.withColumn("nt", F.substring("nt", 1, 1)).groupBy("contig", "pos", "ref").pivot("sample", samples).agg(F.first("nt"))
    return out.na.fill(missing, samples)


def alignment(genotypes: DataFrame) -> DataFrame:
    """sample, seq: sites by contig, then position."""
    rows = genotypes.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("contig", "pos", "nt"))).alias("c"))
    return rows.select("sample", F.array_join(F.transform("c", lambda x: x["nt"]), "").alias("seq"))


def interval_rows(intervals: DataFrame) -> DataFrame:
    """contig, lo, hi, name (`contig:lo`) in order."""
    return intervals.select("contig", "lo", "hi", F.concat_ws(":", "contig", F.col("lo").cast("string")).alias("name")).orderBy("contig", "lo", "hi")
