"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the driver tables (or frames Spark derives from them) in full.
``lapline.plans.oracle.QUERY_SQL`` holds the DuckDB oracle for the names that
SQL can express.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline import schema as S
from lapline.functions.times import format_seconds, time_to_seconds
from lapline.operators import clean as C
from lapline.operators import ingest as K
from lapline.operators import model as M
from lapline.operators import parse as P
from lapline.operators import race_states as R
from lapline.operators import stats as A
from lapline.operators import weblinks as L
from lapline.plans import queries as Q
from lapline.session import ensure_checkpoint_dir
from lapline.sources import fixtures as FX
from lapline.sources import tables as T
from lapline.sources.tables import input_partitions, read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _typed(spark, sf_dir):
    return FX.canonical_results(spark, sf_dir)


# --------------------------------------------------------------------------- Q01-Q17, S11
register("canonical_results")(lambda spark, d: _typed(spark, d))
register("fastest_men")(lambda spark, d: Q.fastest(_typed(spark, d), "M"))
register("fastest_women")(lambda spark, d: Q.fastest(_typed(spark, d), "F"))
register("avg_final_by_sex")(lambda spark, d: Q.avg_final_by_sex(_typed(spark, d)))
register("avg_reaction_by_sex")(lambda spark, d: Q.avg_reaction_by_sex(_typed(spark, d)))
register("missing_late_splits")(lambda spark, d: Q.missing_late_splits(_typed(spark, d)))
register("swimmers_per_race_top10")(lambda spark, d: Q.swimmers_per_race(_typed(spark, d), Q.TOP_N))
register("fastest_per_race_top10")(lambda spark, d: Q.fastest_per_race(_typed(spark, d), Q.TOP_N))
register("swimmers_per_race")(lambda spark, d: Q.swimmers_per_race(_typed(spark, d)))
register("fastest_per_race")(lambda spark, d: Q.fastest_per_race(_typed(spark, d)))
register("avg_final_per_race")(lambda spark, d: Q.avg_final_per_race(_typed(spark, d)))
register("distinct_races_by_sex")(lambda spark, d: Q.distinct_races(_typed(spark, d)))
register("total_races")(lambda spark, d: Q.total_races(_typed(spark, d)))
register("shape_by_sex")(lambda spark, d: Q.shape(_typed(spark, d)))
register("final_time_range")(lambda spark, d: Q.final_time_range(_typed(spark, d)))
register("final_time_range_text")(
    lambda spark, d: Q.final_time_range(FX.raw_results(spark, d), lexical=True))
register("slowest_women")(lambda spark, d: Q.slowest(_typed(spark, d), "F"))
register("preview")(lambda spark, d: Q.preview(_typed(spark, d)))
register("results_row_count")(
    lambda spark, d: _typed(spark, d).agg(F.count(F.lit(1)).alias("row_count")))


# --------------------------------------------------------------------------- P01-P21 (sheets, documents)

# A user pattern for the line search (P20): a capitalised word then a short function word.
LINE_SEARCH_PATTERN = r"[A-Z][a-z]+ (?:the|de|la|der|und|el) "


def _sheets(spark, d):
    return FX.render_sheets(spark, d).select("Link", "text")


def _sections(spark, d):
    found = P.sections(FX.render_sheets(spark, d).select("Link", "session", "text"))
    return found.select("Link", "session", "section", "heat",
                        F.size(P.splitlines(F.col("section_text"))).cast("bigint").alias("n_lines"))


def _docs(spark, d):
    return read_table(spark, d, "documents").select("doc_id", "text")


register("parse_sheets")(lambda spark, d: P.parse_sheets(_sheets(spark, d)))
register("parse_sheets_mixed")(lambda spark, d: P.parse_sheets(FX.render_mixed_sheets(spark, d)))
register("sheet_sections")(_sections)
register("sheet_head")(lambda spark, d: P.head_per_document(P.parse_sheets(_sheets(spark, d)), 2))
register("document_lines")(lambda spark, d: P.lines_of(_docs(spark, d), keep=["doc_id"]))
register("document_noise")(lambda spark, d: P.noise_summary(_docs(spark, d), "doc_id"))
register("document_peek")(lambda spark, d: P.peek(_docs(spark, d), 1200))
register("document_inspect_lines")(lambda spark, d: P.inspect_lines(_docs(spark, d), 80))
register("document_line_search")(
    lambda spark, d: P.regex_line_search(_docs(spark, d), LINE_SEARCH_PATTERN))


# --------------------------------------------------------------------------- S14, L01-L14 (stored pages)

YEARS = (1996, 2000)  # L13: a part of the years that the tables hold (1995 to 2001)
EVERY_YEAR = (0, 9999)

register("page_anchor_links")(lambda spark, d: L.anchor_links(T.read_html_pages(spark, d)))
register("portal_links")(
    lambda spark, d: L.links_per_competition(L.event_links(FX.portal_pages(spark, d))))
register("portal_links_nested")(
    lambda spark, d: L.links_per_competition(L.event_links(FX.portal_pages(spark, d, nested=True))))
register("competition_list")(
    lambda spark, d: L.dedupe_first_seen(
        L.year_range(L.competition_rows(FX.competition_list_pages(spark, d)), *YEARS))
    .select("year", "competition", "href"))
register("link_table")(
    lambda spark, d: L.link_table(FX.competition_list_pages(spark, d), FX.portal_pages(spark, d), *YEARS))
register("link_year_counters")(
    lambda spark, d: L.year_counters(
        spark, FX.competition_list_pages(spark, d),
        L.link_table(FX.competition_list_pages(spark, d), FX.portal_pages(spark, d), *YEARS), *YEARS))


# --------------------------------------------------------------------------- C01-C14


def _parsed_by_sex(spark, d):
    """Rendered sheets parsed, split into the men's and women's frames by the sheet's list."""
    parsed = P.parse_sheets(FX.render_sheets(spark, d).drop("session"))
    men = parsed.filter(F.col("sex") == "M").drop("sex")
    women = parsed.filter(F.col("sex") == "F").drop("sex")
    return men, women


def _links(spark, d):
    return L.link_table(FX.competition_list_pages(spark, d), FX.portal_pages(spark, d), *EVERY_YEAR)


def _work(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapline-{name}-{uuid.uuid4().hex}"


register("results_table")(lambda spark, d: C.prepare_for_sql(*_parsed_by_sex(spark, d)))
register("para_filtered")(lambda spark, d: C.drop_para_class(_typed(spark, d)))
register("short_course_filtered")(lambda spark, d: C.drop_short_course(_typed(spark, d), _links(spark, d)))
register("dropped_competitions")(lambda spark, d: C.dropped_competitions(_links(spark, d)))
register("prepared")(lambda spark, d: C.prepare_data(*_parsed_by_sex(spark, d), work=_work(spark, "prepared")))


def _imputed_prices(spark, d):
    """C08 over a column of distinct doubles: prices of every seventh order missing, filled with the exact median."""
    lines = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.pmod("l_orderkey", F.lit(7)) != 0, F.col("l_extendedprice")).alias("price"))
    return C.impute_median(lines, "price").withColumn("price", F.round("price", 6))


register("imputed_prices")(_imputed_prices)


# --------------------------------------------------------------------------- A01-A08, M01-M14


def _prepared(spark, d):
    """C12 over the results read as text (the parser's output shape), men's and women's lists."""
    raw = FX.raw_results(spark, d)
    return C.prepare_data(raw.filter(F.col("sex") == "M").drop("sex"),
                          raw.filter(F.col("sex") == "F").drop("sex"), work=_work(spark, "prepared"))


def _scored(spark, d):
    prepared = _prepared(spark, d)
    model, _, _ = M.train_model(spark, prepared, partitions=input_partitions(spark))
    return M.predict_batch(model, prepared)


register("correlation_matrix")(lambda spark, d: A.correlation_matrix(_prepared(spark, d)))
register("final_time_histogram")(lambda spark, d: A.histogram(spark, _typed(spark, d), "final_time", 40))
register("ols_split250")(lambda spark, d: M.ols_single(spark, _prepared(spark, d), "split_250m"))
register("holdout_sizes")(lambda spark, d: M.holdout(_prepared(spark, d)).groupBy("is_test").count())
register("fold_sizes")(lambda spark, d: M.with_folds(_prepared(spark, d)).groupBy("fold").count())
register("model_comparison")(lambda spark, d: A.with_label(
    A.sort_by_error(M.compare_models(spark, _prepared(spark, d), partitions=input_partitions(spark))), "mae", "%.3f", "s"))
register("model_comparison_cv")(lambda spark, d: M.compare_models_cv(spark, _prepared(spark, d), partitions=input_partitions(spark)))
register("progressive_accuracy")(
    lambda spark, d: A.error_by_distance(M.progressive_accuracy(spark, _prepared(spark, d), partitions=input_partitions(spark))))
register("feature_importances")(
    lambda spark, d: A.with_label(M.train_model(spark, _prepared(spark, d), partitions=input_partitions(spark))[2], "importance"))
register("scored_results")(_scored)
register("biggest_surprises")(lambda spark, d: A.biggest_surprises(_scored(spark, d), 5))
register("residual_histogram")(lambda spark, d: A.histogram(
    spark, _scored(spark, d), "residual", 40, work=_work(spark, "residuals")))


# --------------------------------------------------------------------------- K01-K11 (ingest)


def _stored(spark, df, name):
    """``df`` written once to a folder that all executors share and read back, for a query that reads it more than once."""
    path = _work(spark, name)
    T.write_results(df, path)
    return spark.read.schema(df.schema).parquet(path)


BUCKETS = 8  # of the stored sheets, at least; a parameter of the store, not of the rows


def _buckets(spark):
    return max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _stored_sheets(spark, d):
    """The name of a table of the sheets in buckets of Link: a long list meets them where they lie, without a shuffle of texts."""
    name = f"lapline_sheets_{uuid.uuid4().hex}"
    T.save_bucketed(_sheets(spark, d), name, _work(spark, "sheets"), _buckets(spark))
    return name


def _resumed(spark, d):
    """Two ingest runs: the first over the links whose md5 starts with 0-7, the second over all.

    The list, the sheets and the first run's rows are stored, as a real run finds them: each is made once, not once for
    each part of the plan that reads it.  Returns the list too.
    """
    links = _stored(spark, K.link_lists(_links(spark, d)), "links")
    docs = spark.table(_stored_sheets(spark, d))
    earlier, _ = K.ingest(links.filter(F.substring(F.md5("Link"), 1, 1) < "8"), docs, S.empty(spark, S.RAW_RESULTS))
    return links, *K.ingest(links, docs, _stored(spark, earlier, "earlier"))


def _report(spark, d):
    links, rows, _ = _resumed(spark, d)
    return K.report(links, rows)


register("link_lists")(lambda spark, d: K.link_lists(_links(spark, d)))
register("ingest_resumed")(lambda spark, d: _resumed(spark, d)[1])
register("ingest_second_run_rows")(lambda spark, d: _resumed(spark, d)[2].groupBy("Link").count())
register("ingest_report")(_report)


def _two_feature_model(spark, d):
    return M.linear_regression(["split_250m", "reaction_time"]).fit(_prepared(spark, d))


def _predict_from_text(spark, d):
    """A two-feature linear model applied to every row's splits as printed (text)."""
    raw = FX.raw_results(spark, d)
    out = M.predict(_two_feature_model(spark, d), raw.select("Link", "heat", "rank", "lane", "reaction_time", *S.FEATURE_SPLITS))
    return out.select("Link", "heat", "rank", "lane", *S.FEATURE_SPLITS, "reaction_time", "predicted_time")


register("predict_from_text")(_predict_from_text)
register("prediction_example")(lambda spark, d: M.prediction_example(spark, _two_feature_model(spark, d)))


# --------------------------------------------------------------------------- models that SQL can check: one or two features

def _linear_scored(spark, d):
    """M13 with a one-feature linear model fitted on the training rows."""
    prepared = _prepared(spark, d)
    tagged = M.holdout(prepared)
    model = M.linear_regression(["split_250m"]).fit(tagged.filter(~F.col("is_test")))
    return M.predict_batch(model, prepared)


LINEAR = {f"Linear {c}": [c] for c in ("split_50m", "split_150m", "split_250m", "reaction_time")}

register("linear_holdout")(lambda spark, d: A.with_label(A.sort_by_error(M.holdout_metrics(
    _prepared(spark, d), {name: M.linear_regression(cols) for name, cols in LINEAR.items()})), "mae", "%.3f", "s"))
register("polynomial_holdout")(lambda spark, d: M.holdout_metrics(
    _prepared(spark, d), {"Polynomial split_250m": M.polynomial_regression(2, ["split_250m"])}))
register("linear_cv")(lambda spark, d: M.compare_models_cv(
    spark, _prepared(spark, d), models={name: M.least_squares(cols) for name, cols in LINEAR.items()}))
register("linear_by_distance")(lambda spark, d: A.error_by_distance(M.progressive_accuracy(
    spark, _prepared(spark, d), estimator=lambda feats: M.least_squares([[c for c in feats if c.startswith("split_")][-1]]))))
register("six_feature_cv")(lambda spark, d: M.compare_models_cv(
    spark, _prepared(spark, d), models={"Linear Regression": M.least_squares(), "Polynomial Regression": M.least_squares(degree=2)}))
register("six_feature_holdout")(lambda spark, d: M.compare_models(
    spark, _prepared(spark, d), models={"Linear Regression": M.least_squares(), "Polynomial Regression": M.least_squares(degree=2)}))

# a forest that SQL can restate: one tree of one split, every row drawn once
STUMP = {"pure": True, "trees": 1, "max_depth": 1, "bootstrap": False}

register("stump_holdout")(lambda spark, d: M.compare_models(spark, _prepared(spark, d), models={"Stump": M.random_forest(**STUMP)}))
register("stump_importances")(lambda spark, d: M.train_model(spark, _prepared(spark, d), forest=STUMP)[2])
register("stump_scored")(lambda spark, d: M.predict_batch(M.train_model(spark, _prepared(spark, d), forest=STUMP)[0], _prepared(spark, d)).select(
    "Link", "heat", "rank", "lane", "last_name", "first_name", F.round("predicted_time", 6).alias("predicted_time"), F.round("residual", 6).alias("residual")))
register("pure_forest_importances")(lambda spark, d: A.with_label(
    M.train_model(spark, _prepared(spark, d), forest={"pure": True, "trees": 10, "partitions": input_partitions(spark)})[2], "importance"))
register("linear_scored")(lambda spark, d: _linear_scored(spark, d).select(
    "Link", "heat", "rank", "lane", "last_name", "first_name", F.round("predicted_time", 6).alias("predicted_time"),
    F.round("residual", 6).alias("residual")))
register("linear_surprises")(lambda spark, d: A.biggest_surprises(
    _linear_scored(spark, d).withColumn("residual", F.round("residual", 4)).withColumn("predicted_time", F.round("predicted_time", 4)), 5))
register("linear_residual_histogram")(lambda spark, d: A.histogram(
    spark, _linear_scored(spark, d).select(F.round("residual", 4).alias("residual")), "residual", 40, work=_work(spark, "residuals")).select(
    "bin", F.round("lo_edge", 6).alias("lo_edge"), F.round("hi_edge", 6).alias("hi_edge"), "n"))


# --------------------------------------------------------------------------- F03, C02, K10, Q11, L07

register("strict_times")(lambda spark, d: FX.raw_results(spark, d).select(
    "Link", "rank", "lane", "last_name", "first_name", *[time_to_seconds(F.col(c), "strict").alias(c) for c in S.TIME_COLS]))
register("labelled_results")(lambda spark, d: C.tag_and_union(*[
    FX.raw_results(spark, d).filter(F.col("sex") == s).drop("sex") for s in ("M", "F")], labels=("Men", "Women")))
register("portal_links_with_25")(
    lambda spark, d: L.links_per_competition(L.event_links(FX.portal_pages(spark, d), exclude_25=False)))


def _stored_in_batches(spark, d):
    """All sheets ingested into a stored table in four batches."""
    output = _work(spark, "stored")
    docs = _stored(spark, _sheets(spark, d), "sheets")
    return K.ingest_to_path(spark, docs.select("Link").distinct(), docs, output, batches=4)


register("ingest_in_batches")(_stored_in_batches)


def _named(spark, d):
    """Q11: every named query over the stored table, one row per result row, its values as text."""
    out = None
    for title, frame in Q.run_named_queries(_typed(spark, d)).items():
        row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in frame.columns])
        part = frame.select(F.lit(title).alias("title"), row.alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


register("named_queries")(_named)


# --------------------------------------------------------------------------- S12 (page form), S13, F04

register("parse_sheet_pages")(
    lambda spark, d: P.parse_sheets(T.join_pages(FX.render_sheet_pages(spark, d), ("Link", "session")).drop("session")))
register("seed_list")(lambda spark, d: T.read_seed_list(
    K.link_lists(_links(spark, d)).select(F.col("Link").alias("pdf_url"))))
register("formatted_final_times")(lambda spark, d: _typed(spark, d).filter(F.col("final_time").isNotNull())
                                  .select("Link", "rank", "lane",
                                          format_seconds(F.col("final_time")).alias("formatted")))
register("slowest_women_text")(
    lambda spark, d: Q.slowest(FX.raw_results(spark, d), "F"))
register("ols_split250_reaction")(
    lambda spark, d: M.ols_pair(spark, _prepared(spark, d), "split_250m", "reaction_time"))


# --------------------------------------------------------------------------- S01-S09, Q08-Q10 by batch, K03/K04 in buckets


def _races_by_batch(spark, d):
    """Q08-Q10 from states: the rows come in four batches, the second one twice, with a merge between."""
    store = _work(spark, "races")
    rows = _typed(spark, d)
    for batch in (0, 1, 1, 2, 3):
        R.add_batch(spark, rows.filter(F.pmod(F.col("rank"), F.lit(4)) == batch), store, batch)
        if batch == 2:
            R.merge(spark, store, 2)
    states = R.current(spark, store)
    return (R.swimmers_per_race(states).join(R.fastest_per_race(states), "Link", "left")
            .join(R.avg_final_per_race(states), "Link", "left"))


register("races_by_batch")(_races_by_batch)

def _ingest_bucketed(spark, d):
    """K03-K09 in buckets: a run over the links whose md5 starts with 0-7, then one over all."""
    buckets, results, path = _buckets(spark), f"lapline_results_{uuid.uuid4().hex}", _work(spark, "results")
    documents = _stored_sheets(spark, d)
    links = _stored(spark, K.link_lists(_links(spark, d)), "links")
    K.ingest_bucketed(spark, links.filter(F.substring(F.md5("Link"), 1, 1) < "8"), documents, results, path, buckets)
    return K.ingest_bucketed(spark, links, documents, results, path, buckets)


register("ingest_bucketed")(_ingest_bucketed)


def _links_file(spark, d):
    """The link table to CSV, the earlier years first and the later ones appended, read back."""
    path, found = _work(spark, "links-csv"), _work(spark, "links")
    T.write_results(_links(spark, d), found)   # the pages are read once for both writes
    links = spark.read.schema(S.LINKS).parquet(found)
    T.write_links(links.filter(F.col("year") < YEARS[1]), path)
    T.write_links(links.filter(F.col("year") >= YEARS[1]), path, mode="append")
    return T.read_links_csv(spark, path)


def _results_file(spark, d):
    """Raw results to CSV, the second half appended, read back as earlier output and as an input."""
    path = _work(spark, "results") + ".csv"
    raw = FX.raw_results(spark, d).select(*S.RAW_RESULTS.names)
    before = T.read_earlier_output(spark, path, fmt="csv")
    T.write_results(raw.filter(F.col("rank") <= 3), path, fmt="csv")
    T.write_results(raw.filter(F.col("rank") > 3), path, fmt="csv", mode="append")
    return before.unionByName(T.normalize_input(spark, path))


def _typed_file(spark, d):
    """Typed results to CSV and back."""
    path = _work(spark, "typed-csv")
    T.write_results(_typed(spark, d).select(*S.TYPED_RESULTS.names), path, fmt="csv")
    return T.read_results_csv(spark, path, typed=True)


def _stored_table(spark, d):
    """The typed rows stored by sex and sorted by Link, asked in SQL."""
    name = f"lapline_table_{uuid.uuid4().hex}"
    T.save_table(_typed(spark, d), name, partition_by=["sex"], sort_within=["Link"], path=_work(spark, "table"))
    return T.sql(spark, f"SELECT sex, count(*) AS swims, count(DISTINCT Link) AS races, min(final_time) AS fastest, "
                        f"max(final_time) AS slowest FROM {name} GROUP BY sex")


register("links_file")(_links_file)
register("results_file")(_results_file)
register("typed_file")(_typed_file)
register("stored_table")(_stored_table)


def _nothing_left(spark, d):
    """A second run over the same list; it has nothing left, so the stored rows stay as they are."""
    output, docs = _work(spark, "stored"), _stored(spark, _sheets(spark, d), "sheets")
    K.ingest_to_path(spark, docs.select("Link").distinct(), docs, output)
    return K.ingest_to_path(spark, docs.select("Link").distinct(), docs, output)


register("ingest_nothing_left")(_nothing_left)
