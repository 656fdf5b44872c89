"""A corpus from raw documents to token ids, in stages that are written and read again.

1. quality rules: documents that fail them go;
2. near-dedup: one document of each class of near copies (five-word shingles, Jaccard similarity of 0.8 or more) stays;
3. PII: personal data and terms that reveal it are generalised in the text;
4. mixing: documents are repeated or left out so that sources come near their target weights;
5. SentencePiece: texts become piece ids (doc_id, lang, source, n_tokens, ids).

Stages 1 to 4 return the columns of documents. A null or empty text fails the quality rules; an empty table gives an empty
result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm import mixing, nearcopies, pieces, pii, quality
from locusframe.llm.store import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.keep_one(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pieces.encode(docs, pieces.Pieces.load(), columns=("doc_id", "lang", "source"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", keep_quality), ("near_dedup", drop_near_copies), ("pii", sanitise), ("mixing", mix_sources), ("sentencepiece", encode)]

#: XXH64 and connected classes are beyond SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
