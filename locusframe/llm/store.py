"""Tables that a job writes once and reads several times, in the folder that spark.checkpoint.dir names; `release` deletes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.sources import kept as written
from locusframe.sources import discard, release, shared_folder

__all__ = ["discard", "documents", "release", "row_key", "shared_folder", "written"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key(df: DataFrame, *columns: str):
    """A key of a row's content, so that rows with the same doc_id and other texts stay apart."""
    return F.xxhash64(*[df[c] for c in columns])
