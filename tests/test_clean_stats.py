import pytest
from pyspark.sql import functions as F

from lapline.operators import clean as C
from lapline.operators import stats as A
from tests.conftest import SF_SMALL


def test_median_imputation_exact(spark):
    df = spark.createDataFrame([(0.70,), (0.80,), (None,), (0.71,), (0.90,)], "reaction_time double")
    out = [r[0] for r in C.impute_median(df).collect()]
    assert sorted(out) == sorted([0.70, 0.80, 0.755, 0.71, 0.90])


def test_prepare_data_drops_and_intervals(spark):
    cols = "Link string, reaction_time double, split_50m string, split_100m string, split_150m string, " \
           "split_200m string, split_250m string, final_time string"
    men = spark.createDataFrame([("a", 0.7, "27.00", "56.00", "1:25.00", "1:54.00", "2:23.00", "3:50.00"),
                                 ("b", None, "27.00", None, "1:25.00", "1:54.00", "2:23.00", "3:50.00")], cols)
    women = spark.createDataFrame([("c", None, "28.00", "58.00", "1:28.00", "1:58.00", "2:28.00", "4:00.00")], cols)
    out = {r.Link: r for r in C.prepare_data(men, women).collect()}
    assert set(out) == {"a", "c"}
    assert out["c"].reaction_time == 0.7 and out["a"].interval_split_100m == 29.0
    assert out["a"].final_time == 230.0


def test_para_and_required(spark):
    df = spark.createDataFrame([("Ann S9",), ("SMith",), ("smith",), (None,)], "first_name string")
    assert sorted(r[0] or "" for r in C.drop_para_class(df).collect()) == ["", "smith"]
    with pytest.raises(ValueError):
        C.require_columns(df, ["residual"])
    with pytest.raises(ValueError):
        C.available_columns(df, ["first_name", "x"])


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,), (4.0,)], "v double")
    h = {r.bin: r.n for r in A.histogram(spark, df, "v", 4).collect()}
    assert h == {1: 1, 2: 1, 3: 1, 4: 1}
    one = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    h1 = {r.bin: r.n for r in A.histogram(spark, one, "v", 40).collect()}
    assert h1[21] == 2 and sum(h1.values()) == 2 and len(h1) == 40


def test_correlation_pairwise(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.5)], "a double, b double")
    m = {(r.row, r.col): r.r for r in A.correlation_matrix(df, ["a", "b"]).collect()}
    assert m[("a", "a")] == 1.0 and m[("a", "b")] == m[("b", "a")] and m[("a", "b")] > 0.99


def test_short_course_filter(spark):
    links = spark.createDataFrame([(2020, "FINA WORLD CUP", "m1", None), (2020, "Nationals", "m2", "w2")],
                                  "year int, competition string, mens_400_free_pdf string, womens_400_free_pdf string")
    res = spark.createDataFrame([("m1",), ("m2",), ("w2",), (None,)], "Link string")
    assert sorted(r[0] or "" for r in C.drop_short_course(res, links).collect()) == ["", "m2", "w2"]
    assert [tuple(r) for r in C.dropped_competitions(links).collect()] == [(2020, "FINA WORLD CUP")]


def test_prepare_for_sql_tags(spark):
    from lapline.sources import fixtures as FX
    raw = FX.raw_results(spark, SF_SMALL)
    typed = C.prepare_for_sql(raw.filter("sex = 'M'").drop("sex"), raw.filter("sex = 'F'").drop("sex"))
    assert dict(typed.dtypes)["final_time"] == "double"
    assert typed.count() == raw.count()
    assert typed.filter(F.col("sex").isNull()).count() == 0


def test_tag_and_union_with_labels(spark):
    men = spark.createDataFrame([("a", "3:50.00")], "Link string, final_time string")
    women = spark.createDataFrame([("b", "4:00.00", 0.7)], "Link string, final_time string, reaction_time double")
    out = {r.Link: r for r in C.tag_and_union(men, women, labels=("Men", "Women")).collect()}
    assert out["a"].sex == "Men" and out["b"].sex == "Women" and out["a"].reaction_time is None


def test_median_imputation_text_column(spark):
    df = spark.createDataFrame([("0.70",), ("bad",), (None,), ("0.80",)], "reaction_time string")
    assert sorted(r[0] for r in C.impute_median(df).collect()) == [0.70, 0.75, 0.75, 0.80]


def test_prepare_data_from_paths_and_with_a_work_folder(spark, tmp_path):
    from lapline.sources import fixtures as FX
    from lapline.sources import tables as T

    raw = FX.raw_results(spark, SF_SMALL)
    sides = [raw.filter(F.col("sex") == s).drop("sex") for s in ("M", "F")]
    for side, name in zip(sides, ("men", "women")):
        T.write_results(side, str(tmp_path / name))
    want = C.prepare_data(*sides)
    got = C.prepare_data(str(tmp_path / "men"), str(tmp_path / "women"), work=str(tmp_path / "work"))
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    T.remove_path(spark, str(tmp_path / "work"))
    assert not (tmp_path / "work").exists()


def test_year_range_leaves_years_out(spark):
    from lapline.operators import weblinks as L
    from lapline.plans.registry import YEARS
    from lapline.sources import fixtures as FX

    rows = L.competition_rows(FX.competition_list_pages(spark, SF_SMALL))
    kept = L.year_range(rows, *YEARS)
    assert 0 < kept.count() < rows.count() and {r.year for r in kept.select("year").distinct().collect()} == set(range(YEARS[0], YEARS[1] + 1))


def test_final_drop_removes_rows_without_any_reaction(spark):
    cols = "Link string, reaction_time double, split_50m string, split_100m string, split_150m string, " \
           "split_200m string, split_250m string, final_time string"
    side = spark.createDataFrame([("a", None, "27.00", "56.00", "1:25.00", "1:54.00", "2:23.00", "3:50.00")], cols)
    assert C.prepare_data(side, side).count() == 0      # no median to fill with: the last drop takes them
