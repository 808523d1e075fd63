"""Registered queries of this subpackage: one ``opN_<name>`` per operator, with production parameters."""

from __future__ import annotations

import functools
import shutil
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline.llm._common import local_temp, scratch_path
from lapline.llm.oracle import oracles


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers (as ``--py-files`` would), once an application."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        made = shutil.make_archive(f"{local_temp('lapline-')}/{root.name}", "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(made)
        _SHIPPED.add(spark.sparkContext.applicationId)


def _registered(query: Callable) -> Callable:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.mixing import schedule

    planned = schedule(table(spark, sf_dir, "documents"))
    return planned.select(F.col("id").alias("doc_id"), "source", "n_tokens", "epoch", "block",
                          F.round(F.col("place") * 1_000_000).cast("long").alias("place_ppm"), "turn", "times")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.html_text import extract

    found = extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.toxicity import fit, held_out, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.substrings import repeats

    found = repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("row.doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.chat import digest, format_conversations

    tricky = "\\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return digest(format_conversations(turns.unionByName(more)))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.token_files import read_token_files, write_token_files

    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.quality import COUNTS, assess

    found = assess(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", *COUNTS, "base_failed", "kept")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.trie import conversation_trie

    return conversation_trie(table(spark, sf_dir, "conversations"), graft=True)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.lexical import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapline.llm.contamination import contaminated

    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {q.__name__: _registered(q) for q in (
    op1_mixing, op2_html_text, op3_top_k, op4_toxicity, op5_simhash, op6_packing, op7_substrings, op8_chat, op9_token_files,
    op10_quality, op11_trie, op12_lexical, op13_decontamination, pipeline)}
ORACLES: dict[str, str] = oracles()
