from pyspark.sql import functions as F

from lapline import schema as S
from lapline.operators import model as M


def _frame(spark, n=200):
    rows = []
    for i in range(n):
        s50 = 26.0 + (i % 17) * 0.1
        splits = [s50 * k + (i % 5) * 0.01 * k for k in range(1, 6)]
        rows.append((f"r{i}", 0.6 + (i % 7) * 0.01, *splits, splits[-1] + 90.0 + (i % 3) * 0.05))
    df = spark.createDataFrame(rows, "Link string, reaction_time double, " + ", ".join(
        f"{c} double" for c in S.FEATURE_SPLITS) + ", final_time double")
    from lapline.operators.clean import add_intervals
    return add_intervals(df)


def test_ols_matches_closed_form(spark):
    df = _frame(spark)
    got = M.ols_single(spark, df, "split_250m").first()
    ref = df.agg(F.regr_slope("final_time", "split_250m").alias("b"),
                 F.regr_intercept("final_time", "split_250m").alias("a")).first()
    assert abs(got.slope - round(ref.b, 4)) < 1e-9 and abs(got.intercept - round(ref.a, 4)) < 1e-9


def test_holdout_and_folds_do_not_depend_on_partitioning(spark):
    df = _frame(spark)
    a = {r.Link: r.is_test for r in M.holdout(df.repartition(1)).collect()}
    b = {r.Link: r.is_test for r in M.holdout(df.repartition(7)).collect()}
    assert a == b and 0.1 < sum(a.values()) / len(a) < 0.3
    folds = M.with_folds(df).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2, 3, 4]


def test_metrics_closed_form(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.0)], "final_time double, prediction double")
    m = M.metrics(df).first()
    assert m.mae == round(1.0 / 3, 3) and m.rmse == round((0.5 / 3) ** 0.5, 3)
    assert m.r2 == round(1 - 0.5 / 2.0, 4)


def test_linear_fit_and_predict_with_text(spark):
    df = _frame(spark)
    model = M.linear_regression().fit(df)
    q = spark.createDataFrame([("26.50", "55.10", "1:24.00", "1:53.20", "2:22.80")],
                              ", ".join(f"{c} string" for c in S.FEATURE_SPLITS))
    out = M.predict(model, q).first()
    assert out.reaction_time == S.DEFAULT_REACTION and out.split_150m == 84.0
    assert abs(out.predicted_time - round(out.predicted_time, 2)) < 1e-9


def test_forest_train_and_score(spark):
    df = _frame(spark)
    M_trees = M.RF_TREES
    try:
        M.RF_TREES = 5
        model, mae, imp = M.train_model(spark, df)
    finally:
        M.RF_TREES = M_trees
    assert mae < 5 and imp.count() == len(S.FEATURE_COLS)
    scored = M.predict_batch(model, df)
    assert {"predicted_time", "residual"} <= set(scored.columns) and "prediction" not in scored.columns
    r = scored.first()
    assert abs(r.residual - (r.predicted_time - r.final_time)) < 1e-9


def test_two_feature_ols_matches_lstsq(spark):
    import numpy as np
    df = _frame(spark)
    model = M.linear_regression(["split_250m", "reaction_time"]).fit(df)
    lr = model.stages[-1]
    rows = df.select("split_250m", "reaction_time", "final_time").collect()
    X = np.array([[r[0], r[1], 1.0] for r in rows])
    y = np.array([r[2] for r in rows])
    coef, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert np.allclose(list(lr.coefficients) + [lr.intercept], coef, atol=1e-6)


def test_cross_validation_means_fold_errors(spark):
    df = _frame(spark, 120)
    trees, rounds = M.RF_TREES, M.GBT_ROUNDS
    try:
        M.RF_TREES, M.GBT_ROUNDS = 3, 3
        out = {r.model_name: r.mae for r in M.compare_models_cv(spark, df, k=3).collect()}
    finally:
        M.RF_TREES, M.GBT_ROUNDS = trees, rounds
    assert set(out) == {"Linear Regression", "Polynomial Regression", "Random Forest", "Gradient Boosting"}
    assert all(v >= 0 for v in out.values()) and out["Linear Regression"] < 1.0


def test_holdout_without_key_columns_uses_all_columns(spark):
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(400)], "x double, y double")
    share = M.holdout(df).filter("is_test").count() / 400
    assert 0.1 < share < 0.3


def test_predict_keeps_rows_that_cannot_be_scored(spark):
    model = M.linear_regression().fit(_frame(spark))
    rows = [("a", "26.50", "55.10", "1:24.00", "1:53.20", "2:22.80", "0.70"), ("b", None, "55.10", "1:24.00", "1:53.20", "2:22.80", "0.70"),
            ("c", "26.50", "55.10", "DNF", "1:53.20", "2:22.80", "0.70"), ("d", "26.50", "55.10", "1:24.00", "1:53.20", "2:22.80", "bad"),
            ("e", "26.50", "55.10", "1:24.00", "1:53.20", "2:22.80", None)]
    df = spark.createDataFrame(rows, "who string, " + ", ".join(f"{c} string" for c in S.FEATURE_SPLITS) + ", reaction_time string")
    out = {r.who: r for r in M.predict(model, df).collect()}
    assert out["a"].predicted_time is not None and out["b"].predicted_time is None and out["c"].predicted_time is None
    assert out["d"].reaction_time == out["e"].reaction_time == S.DEFAULT_REACTION and out["d"].predicted_time == out["e"].predicted_time


def test_forest_settings_reach_every_entry_point(spark, tmp_path):
    df = _frame(spark, 80)
    small = {"trees": 2, "max_depth": 1, "max_bins": 8}
    model, _, _ = M.train_model(spark, df, forest=small)
    forest = model.stages[-1]
    assert forest.getNumTrees == 2 and max(t.depth for t in forest.trees) == 1 and forest.getOrDefault("maxBins") == 8
    assert {r.model_name for r in M.compare_models(spark, df, forest=small).collect()} == set(M.model_set())
    assert M.progressive_accuracy(spark, df, forest=small).count() == 5
    df.write.parquet(str(tmp_path / "prepared"))
    stored, mae, _ = M.train_model(spark, str(tmp_path / "prepared"), forest=small)
    assert M.predict_batch(stored, str(tmp_path / "prepared")).count() == 80 and mae >= 0


def test_histogram_of_scores_makes_each_score_once(spark, tmp_path):
    from lapline.operators import stats as A
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        made.add(1)
        return None if i == 7 else float("nan") if i == 8 else i / 10

    scored = spark.range(100).select(score("id").alias("residual"))
    got = A.histogram(spark, scored, "residual", 5, work=str(tmp_path / "values")).collect()
    assert made.value == 100 and sum(r.n for r in got) == 98
    assert got == A.histogram(spark, scored, "residual", 5).collect()


def test_residual_histogram_reads_stored_scores(spark, tmp_path, monkeypatch):
    from lapline.plans.registry import REGISTRY
    spark.range(1, 200).selectExpr("id AS l_orderkey", "CAST(1 + id % 7 AS INT) AS l_linenumber", "id * 31 % 197 AS l_partkey",
                                   "id * 7 % 101 AS l_suppkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(M, "RF_TREES", 2)
    out = REGISTRY["residual_histogram"](spark, str(tmp_path))
    assert "UDF" not in out._jdf.queryExecution().optimizedPlan().toString()   # the model is not in the plan
    assert sum(r.n for r in out.collect()) == REGISTRY["scored_results"](spark, str(tmp_path)).count() > 0


def test_holdout_metrics_hold_no_rows(spark, monkeypatch):
    """Rows wait in storage with the columns that the models read, not in the executors' memory; figures are the plain ones."""
    df = _frame(spark).withColumn("note", F.lit("x" * 50))
    models = {"one": M.linear_regression(["split_50m"]), "two": M.linear_regression(["split_250m", "reaction_time"])}
    tagged = M.holdout(df)
    want = {n: tuple(M.metrics(e.fit(tagged.filter(~F.col("is_test"))).transform(tagged.filter("is_test"))).first()) for n, e in models.items()}

    def held(*_):
        raise AssertionError("rows are kept in memory")

    seen = []
    monkeypatch.setattr(type(df), "persist", held)
    monkeypatch.setattr(M, "metrics", lambda pred, *a, plain=M.metrics, **k: seen.append(pred.columns) or plain(pred, *a, **k))
    got = {r[0]: tuple(r[1:]) for r in M.holdout_metrics(df, models).collect()}
    assert got == want and all("note" not in c and "Link" not in c for c in seen)


def test_columns_that_estimators_read(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer
    from pyspark.ml.regression import LinearRegression
    df = _frame(spark, 5)
    assert M._inputs([M.linear_regression(["split_50m"]), M.polynomial_regression(2, ["split_250m"])], df) == ["split_50m", "split_250m", "final_time"]
    weighted = Pipeline(stages=[*M.linear_regression(["split_50m"]).getStages()[:1], LinearRegression(labelCol="final_time", weightCol="reaction_time")])
    assert M._inputs([weighted], df) == ["reaction_time", "split_50m", "final_time"]
    assert M._inputs([M.linear_regression(), Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__")])], df) == df.columns
