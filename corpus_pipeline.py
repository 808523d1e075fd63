"""The corpus pipeline: quality rules, near-duplicate removal, substring dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next stage's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lapline.llm._common import scratch_path
from lapline.llm.mixing import mixed
from lapline.llm.packing import pack_documents
from lapline.llm.quality import keep_good
from lapline.llm.simhash import keep_first
from lapline.llm.substrings import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the voted quality rules keep (operator 10)."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the smallest id (operator 5)."""
    return keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier text holds; no row goes (operator 7)."""
    return remove_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources deals them (operator 1)."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens placed in sequences (operator 6)."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("source mixing", source_mixing),
    ("packing", packing),
]

#: SQL cannot express the chain (fingerprint links, level-wise windows, a tokenizer); tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored in the shared folder before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
