"""Cleaning and feature preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline import schema as S
from lapline.functions.quantile import exact_quantile
from lapline.functions.text import PARA_CLASS_PY, SHORT_COURSE_PY, regex_contains
from lapline.functions.times import convert_time_columns, to_double
from lapline.sources.tables import normalize_input


def require_columns(df: DataFrame, cols, what: str = "frame") -> None:
    """C14: fail before running when a needed column is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} must contain column(s): {', '.join(missing)}")


def available_columns(df: DataFrame, cols, minimum: int = 2) -> list[str]:
    """The listed columns present in the frame, in list order."""
    present = [c for c in cols if c in df.columns]
    if len(present) < minimum:
        raise ValueError("Not enough columns available.")
    return present


def tag_and_union(men: DataFrame, women: DataFrame, labels=("M", "F")) -> DataFrame:
    """C01/C02 first half: add ``sex`` to each side and UNION ALL by column name."""
    m = men.withColumn("sex", F.lit(labels[0]))
    w = women.withColumn("sex", F.lit(labels[1]))
    return m.unionByName(w, allowMissingColumns=True)


def prepare_for_sql(men: DataFrame, women: DataFrame, labels=("M", "F")) -> DataFrame:
    """Tagged union with the nine time columns converted (table converter, F02)."""
    return convert_time_columns(tag_and_union(men, women, labels), S.NUMERIC_COLS, "table")


def drop_missing(df: DataFrame, cols=None) -> DataFrame:
    """Drop rows missing any of the 5 feature splits or the final time."""
    return df.dropna(subset=list(cols or S.FEATURE_SPLITS + ["final_time"]))


def drop_para_class(df: DataFrame, col: str = "first_name") -> DataFrame:
    """Drop para-class rows (case-sensitive ``S<digit>``, ``SB`` or ``SM`` in the first name)."""
    return df.filter(~regex_contains(F.col(col), PARA_CLASS_PY))


def short_course_links(links: DataFrame, pattern: str = SHORT_COURSE_PY) -> DataFrame:
    """C06 helper: the non-null result links of short-course competitions, one column ``Link``."""
    sc = links.filter(regex_contains(F.col("competition"), pattern, ignore_case=True))
    both = sc.select(F.explode(F.array("mens_400_free_pdf", "womens_400_free_pdf")).alias("Link"))
    return both.filter(F.col("Link").isNotNull()).distinct()


def drop_short_course(results: DataFrame, links: DataFrame, pattern: str = SHORT_COURSE_PY) -> DataFrame:
    """C06 (optional, off in the reference): remove rows whose Link belongs to a short-course competition.

    A left anti join; the link set is small next to the results and AQE
    broadcasts it at run time when its measured size allows.
    """
    return results.join(short_course_links(links, pattern), "Link", "left_anti")


def dropped_competitions(links: DataFrame, pattern: str = SHORT_COURSE_PY) -> DataFrame:
    """Distinct (year, competition) of the short-course competitions."""
    return (links.filter(regex_contains(F.col("competition"), pattern, ignore_case=True))
            .select("year", "competition").distinct())


def add_intervals(df: DataFrame, splits=None) -> DataFrame:
    """Lap intervals ``interval_<split> = split - previous split``."""
    splits = list(splits or S.FEATURE_SPLITS)
    out = df
    for prev, cur in zip(splits, splits[1:]):
        out = out.withColumn(f"interval_{cur}", F.col(cur) - F.col(prev))
    return out


def build_features(splits) -> list[str]:
    """C11: splits, their intervals and the reaction time."""
    splits = list(splits)
    return splits + [f"interval_{c}" for c in splits[1:]] + ["reaction_time"]


def impute_median(df: DataFrame, col: str = "reaction_time") -> DataFrame:
    """Fill missing values with the exact (interpolated) median of the column.

    The median is found by a few passes of bounded state (``exact_quantile``), whatever number of distinct values the
    column has; ``df`` is read once for each, so give it stored rows (``prepare_data(work=...)``).
    """
    if dict(df.dtypes).get(col) == "string":
        value = to_double(F.col(col))                  # text: coerce, bad -> missing
    else:
        value = F.col(col).cast("double")
        value = F.when(~F.isnan(value), value)          # NaN counts as missing
    median = exact_quantile(df, value, 0.5)
    return df.withColumn(col, F.coalesce(value, F.lit(median).cast("double")))


def as_frame(src, schema=S.RAW_RESULTS) -> DataFrame:
    """S04 for every entry point: a frame as it is, or the frame stored at a path."""
    return src if isinstance(src, DataFrame) else normalize_input(SparkSession.active(), src, schema)


def prepare_data(men, women, work: str | None = None) -> DataFrame:
    """Union → time conversion (F01) → C04 → C09 → C08 → C10.  ``men`` and ``women``: frames or paths.

    No ``sex`` column is added here, as in the reference.  The median needs
    passes over the converted rows before they can be filled.  With ``work``, a
    folder that all executors share, the converted rows are written there once as
    Parquet and read back for all of them; the caller removes the folder.  Without
    it the upstream runs again for each pass.
    """
    df = as_frame(men).unionByName(as_frame(women), allowMissingColumns=True)
    df = convert_time_columns(df, S.TIME_COLS, "ingest")
    df = drop_missing(df)
    if work:
        df.write.mode("overwrite").parquet(work)
        df = df.sparkSession.read.schema(df.schema).parquet(work)
    df = add_intervals(df)
    df = impute_median(df)
    return df.dropna(subset=S.FEATURE_COLS)
