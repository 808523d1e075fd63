"""Sources and sinks.

Every reader takes a declared schema; nothing is inferred.  Writers use one
``mode(...)`` call: a sink is replaced or appended as a whole, never edited
in place, and never written to the path it is being read from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline import schema as S
from lapline.functions.text import last_path_element, py_strip


#: Session setting: tasks that the input tables are dealt over when they are read.  Unset (the default), scan splits stay as
#: they are, which is right wherever a table has many; set it where a table is one file of one row group.
INPUT_PARTITIONS = "spark.lapline.inputPartitions"


def input_partitions(spark: SparkSession) -> int | None:
    found = spark.conf.get(INPUT_PARTITIONS, None)
    return int(found) if found else None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``{sf_dir}/{name}.parquet``, dealt as ``INPUT_PARTITIONS`` says."""
    return spread_input(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), input_partitions(spark))


def spread_input(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread an input over ``partitions`` tasks before CPU-heavy text work (rows do not change).

    None leaves the scan splits as they are: right wherever the input is larger than a few splits.
    """
    return df.repartition(partitions) if partitions else df


def read_links_csv(spark: SparkSession, path: str) -> DataFrame:
    """The link table; an empty field reads as NULL, CRLF line ends are fine."""
    return (spark.read.schema(S.LINKS).option("header", True)
            .option("mode", "PERMISSIVE").csv(path))


def read_results_csv(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """Results written by an earlier run (raw times as text, or typed)."""
    sch = S.TYPED_RESULTS if typed else S.RAW_RESULTS
    return spark.read.schema(sch).option("header", True).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files, on whatever file system it is."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def read_earlier_output(spark: SparkSession, path: str, fmt: str = "parquet",
                        schema: T.StructType = S.RAW_RESULTS) -> DataFrame:
    """Earlier output that may be absent or empty; absent gives an empty frame.

    A frame without a ``Link`` column is returned as it is; the caller then
    keeps its rows but skips nothing (the reference's behaviour).
    """
    if not path_exists(spark, path):
        return S.empty(spark, schema)
    reader = spark.read
    if fmt == "csv":
        return reader.schema(schema).option("header", True).csv(path)
    try:
        return reader.parquet(path)
    except Exception as exc:  # an empty folder has no parquet footer to read
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return S.empty(spark, schema)
        raise


def normalize_input(spark: SparkSession, src, schema: T.StructType = S.RAW_RESULTS) -> DataFrame:
    """Accept a DataFrame or a path (CSV with header, or parquet)."""
    if isinstance(src, DataFrame):
        return src
    if isinstance(src, str) and src.endswith(".csv"):
        return spark.read.schema(schema).option("header", True).csv(src)
    if isinstance(src, str):
        return spark.read.parquet(src)
    raise TypeError(f"expected a DataFrame or a path, got {type(src).__name__}")


def write_results(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """S05 (overwrite) and S07 (append): one write of the whole frame."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_links(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The link table as CSV with a header; missing links stay empty."""
    (df.select([F.col(f.name).cast(f.dataType) for f in S.LINKS.fields])
     .write.mode(mode).option("header", True).csv(path))


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               partition_by: list[str] | None = None, sort_within: list[str] | None = None, path: str | None = None) -> None:
    """Replace a catalog table (parquet); optionally partitioned (e.g. by ``sex``) and
    sorted within each file (e.g. by ``Link``), so parquet min/max statistics let filters on
    those columns skip files and row groups — the role the reference's indexes played.  ``path``: where its files lie
    (None: the warehouse)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "Link", mode: str = "overwrite") -> None:
    """S08/S12 form for joins on ``key``: a catalog table over ``path`` in ``buckets`` buckets of the key.

    A frame hash-partitioned by the key over as many partitions joins it where the bucket lies, so the table is not
    shuffled.  A bucket is read by one task: choose ``buckets`` for some 256 MB in each.  Equal keys share a bucket.
    Rows are dealt by the key before the write, so a bucket gets one file a write.
    """
    (df.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key)
     .option("path", path).saveAsTable(name))


def sql(spark: SparkSession, query: str) -> DataFrame:
    """Any SQL over registered tables and views."""
    return spark.sql(query)


def table_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column (cid, name, type, notnull, dflt_value, pk), like SQLite's table_info."""
    rows = [(i, f.name, f.dataType.simpleString().upper(), 0 if f.nullable else 1, None, 0)
            for i, f in enumerate(df.schema.fields)]
    sch = "cid INT, name STRING, type STRING, notnull INT, dflt_value STRING, pk INT"
    return spark.createDataFrame(rows, sch)


def count_rows(df: DataFrame) -> int:
    """Row count."""
    return df.count()


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document file ``(Link, text)`` read as whole text."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("Link"), F.col("value").alias("text"))


def join_pages(pages: DataFrame, key=("Link",)) -> DataFrame:
    """S12 (page form): ``(*key, page, text)`` to ``(*key, text)``; pages without text are skipped.

    Pages are joined in page order with a newline.  ``key`` names one
    document: its pages make one text, the unit of parsing, and nothing else
    is gathered.  A race with many sheets has one document per sheet, so the
    key then holds the sheet too.
    """
    kept = pages.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    agg = kept.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("page", "text"))).alias("pages"))
    return agg.select(*key, F.array_join(F.transform("pages", lambda p: p["text"]), "\n").alias("text"))


def read_seed_list(df: DataFrame, url_col: str = "pdf_url") -> DataFrame:
    """Seed rows with a non-blank URL and the file name taken from it."""
    url = py_strip(F.col(url_col))
    return (df.filter(url.isNotNull() & (url != ""))
            .select(url.alias("url"), last_path_element(url).alias("file_name")))


def read_html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored web pages ``(page_id, url, html)``."""
    return read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
