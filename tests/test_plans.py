"""Physical-plan properties the design relies on."""

from lapline.plans.registry import REGISTRY
from tests.conftest import SF_SMALL

# queries whose callables fit models while the plan is built
TRAINED = {"model_comparison", "model_comparison_cv", "progressive_accuracy", "feature_importances",
           "scored_results", "biggest_surprises", "residual_histogram", "ols_split250", "predict_from_text",
           "ols_split250_reaction", "prediction_example", "linear_holdout", "polynomial_holdout", "linear_cv", "linear_by_distance",
           "linear_scored", "linear_surprises", "linear_residual_histogram", "ingest_in_batches"}
# of these, the ones whose result is a plan over all rows; a fitted model is the only Python function they may hold
SCORING = ("predict_from_text", "linear_scored")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_evaluation_in_registered_plans(spark):
    for name, fn in REGISTRY.items():
        if name in TRAINED:
            continue
        plan = _plan(fn(spark, SF_SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
            assert marker not in plan, (name, marker)


def test_scan_reads_only_needed_columns(spark):
    df = REGISTRY["fastest_per_race"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = [line for line in plan.splitlines() if "ReadSchema" in line or "lineitem" in line]
    text = " ".join(schema)
    for col in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"):
        assert col not in text


def test_head_per_document_limits_before_shuffle(spark):
    plan = _plan(REGISTRY["sheet_head"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_example_prediction(spark):
    from lapline.operators import model as M
    from lapline.plans.registry import _prepared
    model = M.linear_regression().fit(_prepared(spark, SF_SMALL))
    row = M.prediction_example(spark, model).first()
    assert row.formatted.endswith(")") and row.formatted.startswith(f"{row.predicted_time:.2f}s (")


def test_scoring_plans_do_not_shuffle(spark):
    for name in SCORING:
        plan = _plan(REGISTRY[name](spark, SF_SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert marker not in plan, (name, marker)
        assert plan.split("Subquery")[0].count("Exchange hashpartitioning") == 0, name


def test_results_are_a_scan_and_a_projection(spark):
    plan = _plan(REGISTRY["canonical_results"](spark, SF_SMALL))
    assert "Exchange" not in plan and "Window" not in plan


def test_building_a_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "building frames")
    try:
        for name, fn in REGISTRY.items():
            if name not in TRAINED:
                fn(spark, SF_SMALL)
        # reading a Parquet schema is a job of one task of its own group; nothing else may run
        assert all(len(tracker.getJobInfo(j).stageIds) == 1 for j in tracker.getJobIdsForGroup("build-only"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
