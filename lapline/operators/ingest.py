"""Resumable ingest of result sheets (K01-K11), batch form.

The reference loops over links in a process pool, skips links already in
its output file, and rewrites the file every ten documents.  Here one run is
one Spark job: the link list is anti-joined with the links already stored,
the remaining documents are parsed as column expressions, and the new rows
are appended to the stored table in one write.  A failed run leaves the
stored table as it was; the next run redoes only what is missing.  Links
that gave no row are tried again at every run, as in the reference
(finished work is known from output rows).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline import schema as S
from lapline.operators.parse import parse_sheets, rows_per_document
from lapline.session import ensure_checkpoint_dir
from lapline.sources.tables import read_earlier_output, remove_path, write_results


def link_lists(links: DataFrame) -> DataFrame:
    """The men's and women's links as one list ``(sex, Link)``; duplicates kept.

    Anything but a DataFrame raises (the reference returned ``(None, None)``).
    """
    if not isinstance(links, DataFrame):
        raise TypeError(f"expected a DataFrame of links, got {type(links).__name__}")
    require = {"mens_400_free_pdf", "womens_400_free_pdf"}
    if not require.issubset(links.columns):
        raise ValueError("link table must contain mens_400_free_pdf and womens_400_free_pdf")
    both = links.select(F.inline(F.array(
        F.struct(F.lit("M").alias("sex"), F.col("mens_400_free_pdf").alias("Link")),
        F.struct(F.lit("F").alias("sex"), F.col("womens_400_free_pdf").alias("Link")))))
    return both.filter(F.col("Link").isNotNull())


def processed_links(earlier: DataFrame) -> DataFrame | None:
    """Distinct non-null Links already in the output; None when it has no Link column."""
    if "Link" not in earlier.columns:
        return None
    return earlier.select(F.col("Link").cast("string")).dropna().distinct()


def remaining_links(links: DataFrame, earlier: DataFrame) -> DataFrame:
    """The list minus links already processed (a left anti join; list duplicates stay)."""
    done = processed_links(earlier)
    if done is None:
        return links
    return links.join(done, "Link", "left_anti")


def ingest(links: DataFrame, documents: DataFrame, earlier: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K04-K09 as one plan: (all rows = earlier + new, new rows only).

    ``documents`` holds ``(Link, text)``; a listed link without a document
    (a failed fetch) or without a parsed row simply adds nothing (K07).  A
    link listed twice is processed twice, as in the reference.
    """
    todo = remaining_links(links.select("Link"), earlier)
    docs = documents.join(todo, "Link", "inner")
    new_rows = parse_sheets(docs.select("Link", "text"))
    all_rows = earlier.unionByName(new_rows, allowMissingColumns=True)
    return all_rows, new_rows


def ingest_to_path(spark: SparkSession, links: DataFrame, documents: DataFrame, output: str,
                   batches: int | None = None, work: str | None = None) -> DataFrame:
    """K10 batch form: append new rows to ``output`` (parquet); returns the stored table.

    Without ``batches`` the remaining documents are parsed and appended in one
    job.  With ``batches`` each of that many parts is appended (committed)
    before the next, like the reference's checkpoint every ten documents: the
    remaining documents are first written once to ``work`` (a folder all
    executors share; default: a new one under the checkpoint folder), one
    directory per hash of the Link, and a batch reads its directory alone, so
    the corpus is read twice however many batches there are.  A run that stops
    leaves the batches already appended; the next one takes up the links that
    are missing.  ``work`` is removed at the end.  A link listed twice is
    processed twice, as in ``ingest``.
    """
    earlier = read_earlier_output(spark, output)
    docs = documents.join(remaining_links(links.select("Link"), earlier), "Link", "inner").select("Link", "text")
    if batches:
        work = work or f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapline-ingest-{uuid.uuid4().hex}"
        try:
            part = F.pmod(F.xxhash64("Link"), F.lit(batches)).cast("int")
            docs.withColumn("batch", part).write.partitionBy("batch").parquet(work)
            schema = T.StructType([*docs.schema.fields, T.StructField("batch", T.IntegerType())])
            stored = spark.read.schema(schema).parquet(work)
            for b in range(batches):
                write_results(parse_sheets(stored.filter(F.col("batch") == b).select("Link", "text")), output, mode="append")
        finally:
            remove_path(spark, work)
    else:
        write_results(parse_sheets(docs), output, mode="append")
    return spark.read.schema(S.RAW_RESULTS).parquet(output)


def ingest_bucketed(spark: SparkSession, links: DataFrame, documents: str, results: str, path: str, buckets: int) -> DataFrame:
    """K03-K09 where only the list moves: documents and results are tables in ``buckets`` buckets of Link.

    ``documents`` names a table ``(Link, text)`` written by ``save_bucketed``; ``results`` names the output, made over
    ``path`` at the first run.  The list is dealt by Link over as many partitions; done links, the list and the
    documents then meet bucket by bucket, with no shuffle of texts or of stored rows however long the list is.
    New rows stay in their document's partition, so a run appends one file a bucket, as one commit.  A link listed
    twice is processed twice; links without a document or a row add nothing and are tried again.
    """
    todo = links.select("Link").repartition(buckets, "Link")
    if spark.catalog.tableExists(results):
        todo = remaining_links(todo, spark.table(results).hint("merge"))
    docs = spark.table(documents).join(todo.hint("merge"), "Link", "inner")
    new_rows = parse_sheets(docs.select("Link", "text"))
    (new_rows.write.mode("append").format("parquet").bucketBy(buckets, "Link").option("path", path).saveAsTable(results))
    return spark.table(results)


def report(links: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows parsed per listed link, zero for links that gave none."""
    return rows_per_document(rows, links.select("Link"))
