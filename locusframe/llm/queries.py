"""The registered queries of this subpackage; each works on the whole table that it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusframe.llm import audit, crosstok, language, mixing, pieces, pii, toxicity, urls
from locusframe.llm.fingerprint import edits
from locusframe.llm.quality import assess
from locusframe.llm.rlz import remove_repeats
from locusframe.llm.simhash import classes
from locusframe.llm.store import documents
from locusframe.llm.suffixes import remove_repeated_bytes


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.assess(documents(spark, sf_dir), labels).select("doc_id", "held_out", "score", "predicted", "evidence", "neighbours", "nearest", "voters")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), digest=True)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(documents(spark, sf_dir), pieces.Pieces.load())


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(documents(spark, sf_dir), digest=True)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(documents(spark, sf_dir))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(urls.RULES), "host string, path string, verdict string")
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.align(documents(spark, sf_dir), crosstok.Tokenizers.load())


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_ALL = (
    op1_document_fingerprints,
    op2_toxicity,
    op3_source_mixing,
    op4_pii,
    op5_language_id,
    op6_substring_dedup,
    op7_sentencepiece,
    op8_simhash_near_dedup,
    op9_suffix_array_dedup,
    op10_quality_rules,
    op11_url_filters,
    op12_tokenizer_alignment,
    op13_filter_audit,
    pipeline,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES: dict[str, str] = {"op3_source_mixing": mixing.ORACLE, "op11_url_filters": urls.ORACLE, "op13_filter_audit": audit.ORACLE}
