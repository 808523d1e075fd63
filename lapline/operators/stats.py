"""Descriptive statistics and report frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline import schema as S
from lapline.operators.clean import available_columns, require_columns


def correlation_matrix(df: DataFrame, cols=None, digits: int | None = 6) -> DataFrame:
    """Pearson r for every ordered pair ``(row, col, r)``, all pairs in one aggregate pass.

    ``F.corr`` drops a pair's missing values pairwise, as pandas does.
    """
    cols = available_columns(df, cols or S.CORR_COLS)
    # r is symmetric: aggregate each unordered pair once, then emit both orders
    aggs = [F.corr(a, b).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    wide = df.agg(*aggs)
    cells = F.array(*[F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"),
                               F.col(f"{min(i, j)}_{max(i, j)}").alias("r"))
                      for i, a in enumerate(cols) for j, b in enumerate(cols)])
    out = wide.select(F.inline(cells))
    if digits is not None:
        out = out.withColumn("r", F.round("r", digits))
    return out


def histogram(spark: SparkSession, df: DataFrame, col: str, bins: int = 40, work: str | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] with every bin listed ``(bin, lo, hi, n)``.

    Missing values are dropped; the maximum falls in the last bin; when
    min = max the range is widened by 0.5 on each side (numpy's rule).
    The values are read for the range and for the counts.  With ``work``, a folder that all executors share, they are
    written there once and read back for both, so a column that is dear to make (a model's score) is made once a row.
    """
    v = df.select(F.col(col).cast("double").alias("v"))
    if work:
        v.write.mode("overwrite").parquet(work)
        v = spark.read.schema(v.schema).parquet(work)
    v = v.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    # min and max in one pass, a scalar subquery (one row, no join) read once per branch
    rng = v.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()

    def with_range(frame: DataFrame) -> DataFrame:
        r = frame.withColumn("_r", rng)
        same = F.col("_r.lo") == F.col("_r.hi")
        return (r.withColumn("_lo", F.when(same, F.col("_r.lo") - 0.5).otherwise(F.col("_r.lo")))
                .withColumn("_hi", F.when(same, F.col("_r.hi") + 0.5).otherwise(F.col("_r.hi"))))

    lo, hi = F.col("_lo"), F.col("_hi")
    idx = F.least(F.floor((F.col("v") - lo) * (F.lit(float(bins)) / (hi - lo))), F.lit(bins - 1)) + 1
    counts = (with_range(v).select(idx.cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    width = (hi - lo) / bins
    grid = with_range(spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")))
    grid = grid.select("bin", (lo + (F.col("bin") - 1) * width).alias("lo_edge"),
                       (lo + F.col("bin") * width).alias("hi_edge"))
    # the counts hold at most `bins` rows
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", "lo_edge", "hi_edge", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def biggest_surprises(scored: DataFrame, n: int = 5) -> DataFrame:
    """The n largest residuals (predicted − actual: positive = faster than predicted)."""
    require_columns(scored, ["residual"], "scored frame")
    cols = ["last_name", "first_name", "final_time", "predicted_time", "residual"]
    return (scored.select(*cols)
            .orderBy(F.col("residual").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in cols[:4]])
            .limit(n))


def importances_frame(spark: SparkSession, names, values) -> DataFrame:
    """``(feature, importance)`` sorted by importance, largest first."""
    rows = [(str(n), float(v)) for n, v in zip(names, values)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature")


def error_by_distance(progress: DataFrame) -> DataFrame:
    """The progressive-accuracy table with the distance in metres."""
    require_columns(progress, ["mae", "splits_used"], "progress frame")
    dist = F.regexp_extract("splits_used", r"([0-9]+)m$", 1).cast("int")
    return progress.withColumn("distance_m", dist).orderBy("distance_m")


def sort_by_error(models: DataFrame) -> DataFrame:
    """Model table sorted by MAE."""
    require_columns(models, ["model_name", "mae"], "model frame")
    return models.orderBy("mae", "model_name")


def with_label(df: DataFrame, value_col: str, fmt: str = "%.3f", suffix: str = "") -> DataFrame:
    """The data behind a bar chart: value plus its printed label."""
    return df.withColumn("label", F.concat(F.format_string(fmt, F.col(value_col)), F.lit(suffix)))
