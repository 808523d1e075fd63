"""Declared schemas (never inferred) and the fixed column lists."""

from pyspark.sql import types as T

# Column names and orders of the reference's tables.
TIME_SPLITS = ["split_50m", "split_100m", "split_150m", "split_200m",
               "split_250m", "split_300m", "split_350m"]
TIME_COLS = TIME_SPLITS + ["final_time"]                   # converted for models
NUMERIC_COLS = ["reaction_time"] + TIME_COLS               # converted for the table
RAW_COLUMNS = ["heat", "rank", "lane", "last_name", "first_name", "reaction_time",
               *TIME_SPLITS, "final_time"]
FEATURE_SPLITS = ["split_50m", "split_100m", "split_150m", "split_200m", "split_250m"]
INTERVAL_COLS = [f"interval_{c}" for c in FEATURE_SPLITS[1:]]
FEATURE_COLS = FEATURE_SPLITS + INTERVAL_COLS + ["reaction_time"]
CORR_COLS = ["reaction_time", "split_50m", "split_100m", "split_150m",
             "split_200m", "split_250m", "final_time"]
SPLIT_DISTANCES = ["50", "100", "150", "200", "250", "300", "350"]
DEFAULT_REACTION = 0.72

LINKS = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("competition", T.StringType()),
    T.StructField("mens_400_free_pdf", T.StringType()),
    T.StructField("womens_400_free_pdf", T.StringType()),
])

SHEETS = T.StructType([
    T.StructField("Link", T.StringType()),
    T.StructField("text", T.StringType()),
])

SHEET_PAGES = T.StructType([
    T.StructField("Link", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

RAW_RESULTS = T.StructType([
    T.StructField("Link", T.StringType()),
    T.StructField("heat", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("lane", T.IntegerType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("reaction_time", T.DoubleType()),
    *[T.StructField(c, T.StringType()) for c in TIME_SPLITS],
    T.StructField("final_time", T.StringType()),
])

TYPED_RESULTS = T.StructType([
    T.StructField("Link", T.StringType()),
    T.StructField("heat", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("lane", T.IntegerType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("reaction_time", T.DoubleType()),
    *[T.StructField(c, T.DoubleType()) for c in TIME_SPLITS],
    T.StructField("final_time", T.DoubleType()),
    T.StructField("sex", T.StringType()),
])

HTML_PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


def empty(spark, schema):
    """An empty frame with a declared schema (zero-row outputs keep their columns)."""
    return spark.createDataFrame([], schema)
