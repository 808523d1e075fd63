"""Q01-Q17: the questions asked of the results table.

All take the typed results frame (times in seconds) and return a lazy frame.
Means are taken over integer hundredths and rounded half up with integer
arithmetic, so they do not depend on summation order or on how an engine
rounds a double; ties in every top-k are broken over all output columns.
Aggregates are partial (map-side) before their shuffle, so a race holding a
large share of the rows is combined per task before it is exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.functions.times import centis, half_up_mean

TOP_N = 10


def fastest(df: DataFrame, sex: str, n: int = TOP_N) -> DataFrame:
    """Q01/Q02: the n fastest swims of one sex."""
    return (df.filter((F.col("sex") == sex) & F.col("final_time").isNotNull())
            .select("first_name", "last_name", "final_time")
            .orderBy(F.col("final_time").asc(), F.col("last_name").asc_nulls_first(),
                     F.col("first_name").asc_nulls_first())
            .limit(n))


def avg_final_by_sex(df: DataFrame) -> DataFrame:
    """Q03: mean final time per sex, 2 digits."""
    cs = centis(F.col("final_time"))
    return (df.filter(F.col("final_time").isNotNull())
            .groupBy("sex").agg(F.sum(cs).alias("s"), F.count(F.lit(1)).alias("n"))
            .select("sex", half_up_mean(F.col("s"), F.col("n"), 2).alias("avg_final_time")))


def avg_reaction_by_sex(df: DataFrame) -> DataFrame:
    """Q04: mean reaction time per sex, 3 digits."""
    cs = centis(F.col("reaction_time"))
    return (df.filter(F.col("reaction_time").isNotNull())
            .groupBy("sex").agg(F.sum(cs).alias("s"), F.count(F.lit(1)).alias("n"))
            .select("sex", half_up_mean(F.col("s"), F.col("n"), 3).alias("avg_reaction_time")))


def missing_late_splits(df: DataFrame) -> DataFrame:
    """Q05: rows missing the 300 m or the 350 m split (one row, also when zero)."""
    miss = F.col("split_300m").isNull() | F.col("split_350m").isNull()
    return df.agg(F.count_if(miss).cast("bigint").alias("missing_late_splits"))


def swimmers_per_race(df: DataFrame, n: int | None = None) -> DataFrame:
    """Q06 (top n) / Q08 (all): rows per race, most first; a NULL Link is a group."""
    out = df.groupBy("Link").agg(F.count(F.lit(1)).alias("swimmer_count"))
    out = out.orderBy(F.col("swimmer_count").desc(), F.col("Link").asc_nulls_first())
    return out.limit(n) if n else out


def fastest_per_race(df: DataFrame, n: int | None = None) -> DataFrame:
    """Q07 (top n) / Q09 (all): best final time per race, fastest first."""
    out = (df.filter(F.col("final_time").isNotNull())
           .groupBy("Link").agg(F.min("final_time").alias("fastest_time")))
    out = out.orderBy(F.col("fastest_time").asc(), F.col("Link").asc_nulls_first())
    return out.limit(n) if n else out


def avg_final_per_race(df: DataFrame) -> DataFrame:
    """Q10: mean final time per race, 2 digits, ascending."""
    cs = centis(F.col("final_time"))
    return (df.filter(F.col("final_time").isNotNull())
            .groupBy("Link").agg(F.sum(cs).alias("s"), F.count(F.lit(1)).alias("n"))
            .select("Link", half_up_mean(F.col("s"), F.col("n"), 2).alias("avg_final_time"))
            .orderBy(F.col("avg_final_time").asc(), F.col("Link").asc_nulls_first()))


def distinct_races(df: DataFrame, by: str = "sex") -> DataFrame:
    """Q12: distinct non-null Links per group."""
    return df.groupBy(by).agg(F.count_distinct("Link").alias("races"))


def total_races(df: DataFrame) -> DataFrame:
    """Q13: men's distinct races plus women's distinct races (not a distinct count of the union)."""
    per = distinct_races(df)
    return per.agg(F.sum("races").cast("bigint").alias("total_races"))


def shape(df: DataFrame, by: str = "sex") -> DataFrame:
    """Q14: rows and columns per group."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"),
                              F.lit(len(df.columns)).alias("columns"))


def final_time_range(df: DataFrame, by: str = "sex", lexical: bool = False) -> DataFrame:
    """Q15: min and max final time per group; ``lexical`` compares the text as the reference did."""
    col = F.col("final_time")
    if lexical:
        col = col.cast("string")
    return df.groupBy(by).agg(F.min(col).alias("min_final_time"), F.max(col).alias("max_final_time"))


def slowest(df: DataFrame, sex: str | None = None, n: int = TOP_N) -> DataFrame:
    """Q16: the n slowest swims, four columns (NULL times last)."""
    src = df if sex is None else df.filter(F.col("sex") == sex)
    return (src.select("first_name", "last_name", "final_time", "Link")
            .orderBy(F.col("final_time").desc_nulls_last(), F.col("first_name").asc_nulls_first(),
                     F.col("last_name").asc_nulls_first(), F.col("Link").asc_nulls_first())
            .limit(n))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Q17: the first n rows in a defined order (all columns as the sort key)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)


# --------------------------------------------------------------------------- Q11

# The titles of the reference's named queries, and the query each one names here.
NAMED = {
    "Top 10 fastest men's swims": "fastest_men",
    "Top 10 fastest women's swims": "fastest_women",
    "Average final time by sex": "avg_final_by_sex",
    "Average reaction time by sex": "avg_reaction_by_sex",
    "Rows missing late splits": "missing_late_splits",
    "Swimmers parsed per race": "swimmers_per_race_top10",
    "Fastest swim per race": "fastest_per_race_top10",
}


def run_named_queries(df: DataFrame) -> dict:
    """Q11: title -> lazy result frame of each named query."""
    forms = all_queries(df)
    return {title: forms[name] for title, name in NAMED.items()}


def all_queries(df: DataFrame) -> dict:
    """Every Q operator over one frame, as lazy DataFrames (the exact-arithmetic forms)."""
    return {
        "fastest_men": fastest(df, "M"),
        "fastest_women": fastest(df, "F"),
        "avg_final_by_sex": avg_final_by_sex(df),
        "avg_reaction_by_sex": avg_reaction_by_sex(df),
        "missing_late_splits": missing_late_splits(df),
        "swimmers_per_race_top10": swimmers_per_race(df, TOP_N),
        "fastest_per_race_top10": fastest_per_race(df, TOP_N),
        "swimmers_per_race": swimmers_per_race(df),
        "fastest_per_race": fastest_per_race(df),
        "avg_final_per_race": avg_final_per_race(df),
    }
