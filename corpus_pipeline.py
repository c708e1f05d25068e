"""Documents to training files: five stages, each over all that the one before it kept.

Every stage is written as Parquet in the shared folder and read again as the next one's
documents. The first three drop documents, the fourth repeats them, the last writes their
token ids to files and returns one row per document written.

SQL cannot express the learned, hashed and tokenized stages, so there is no ORACLE_SQL;
tests compare the stages with plain versions on small tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import decontaminate, mixing, simhash, token_files, toxicity
from meterline.llm.queries import importable
from meterline.scratch import fresh_path

ORACLE_SQL = None


def mild(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.keep_mild(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark text."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document written: doc_id, start, n_tokens, ids_crc32."""
    return token_files.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", mild),
    ("near_dedup", distinct),
    ("decontamination", clean),
    ("mixing", mixed),
    ("token_files", tokenized),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table documents."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
