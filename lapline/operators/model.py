"""Training, evaluation and scoring (M01-M14) with ``pyspark.ml``.

Settings and their relation to the reference's library defaults:

* Linear and polynomial models are fitted on the six base columns (five
  splits and the reaction time).  The four interval features are exact
  differences of the splits, so they add no rank to a linear model; the
  fitted predictions are the same and the normal equations stay well posed.
* Random forest: 100 trees, every feature considered at each split (the
  reference library's regression default), bootstrap, seed 42.  Every entry point
  that fits a forest takes its settings (``forest={...}``): ``{"pure": True}`` grows
  trees until their leaves are pure, as the reference does (``operators/forest.py``);
  otherwise ``pyspark.ml`` grows them level by level over binned values to
  ``max_depth`` (``RF_MAX_DEPTH``), ``max_bins`` (``RF_MAX_BINS``).
* Where only errors are asked for, linear and polynomial models are solved from moment
  matrices (``operators/gram.py``): three jobs for all models and folds.
* Gradient boosting: 100 rounds, step 0.1, depth 3, seed 42.
* Hold-out and folds come from an md5 hash of each row's identifying values,
  so they do not depend on row order or partitioning (the reference used
  row order) and can be reproduced by any SQL engine.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lapline import schema as S
from lapline.functions.times import time_to_seconds, to_double
from lapline.operators.clean import add_intervals, as_frame, build_features, require_columns
from lapline.operators.forest import PureForest, PureForestModel
from lapline.operators.gram import LeastSquares, cross_validated, held_out
from lapline.operators.stats import importances_frame
from lapline.session import ensure_checkpoint_dir

LABEL = "final_time"
SEED = 42
TEST_FRACTION = 0.2
RF_TREES = 100
RF_MAX_DEPTH = 10
RF_MAX_BINS = 64
GBT_ROUNDS = 100
BASE_COLS = S.FEATURE_SPLITS + ["reaction_time"]
# Tree training: keep each row's node ids between levels instead of walking every
# tree again, checkpoint that cache (to spark.checkpoint.dir) every 10 iterations,
# and give the per-level statistics a moderate memory budget.
TREE_RUNTIME = dict(cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=512)
PROGRESSIVE_SPLITS = [S.FEATURE_SPLITS[:i] for i in range(1, 6)]
# Rows are identified by their text and integer columns (printed the same by every engine).
ROW_KEY = ["Link", "heat", "rank", "lane", "last_name", "first_name"]
KEY_SEP = "\u001f"


# --------------------------------------------------------------------------- M01, M07: stable row assignment

def _row_hash(df: DataFrame, cols, seed: int) -> F.Column:
    """A 60-bit hash of the row's identifying columns, reproducible in any SQL engine:
    md5 of the seed and the columns' text joined by U+001F (NULLs skipped), first 15 hex digits."""
    cols = [c for c in (cols or ROW_KEY) if c in df.columns] or df.columns   # no key columns: all of them
    text = F.concat_ws(KEY_SEP, F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def holdout(df: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SEED, cols=None) -> DataFrame:
    """Adds ``is_test``; about ``test_fraction`` of rows, chosen by a hash of the row."""
    bucket = F.pmod(_row_hash(df, cols, seed), F.lit(10_000))
    return df.withColumn("is_test", bucket < int(round(test_fraction * 10_000)))


def with_folds(df: DataFrame, k: int = 5, seed: int = SEED, cols=None) -> DataFrame:
    """Adds an integer ``fold`` in [0, k) from a hash of the row."""
    return df.withColumn("fold", F.pmod(_row_hash(df, cols, seed + 1), F.lit(k)).cast("int"))


# --------------------------------------------------------------------------- M02-M05: estimators

def linear_regression(features=None) -> Pipeline:
    """M02."""
    feats = list(features or BASE_COLS)
    return Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol=LABEL, solver="normal")])


def polynomial_regression(degree: int = 2, features=None) -> Pipeline:
    """Standardise, degree-n expansion without bias, then least squares."""
    feats = list(features or BASE_COLS)
    return Pipeline(stages=[
        VectorAssembler(inputCols=feats, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True),
        PolynomialExpansion(inputCol="scaled", outputCol="features", degree=degree),
        LinearRegression(featuresCol="features", labelCol=LABEL, solver="normal")])


def random_forest(features=None, trees: int | None = None, max_depth: int | None = None,
                  max_bins: int | None = None, pure: bool = False, **growth) -> Pipeline | PureForest:
    """M04 (defaults: the module settings at call time).  ``pure``: grown to purity; ``max_depth`` is then no cap unless
    given, and ``growth`` has further settings of :class:`PureForest`."""
    feats = list(features or S.FEATURE_COLS)
    if pure:
        return PureForest(feats, LABEL, trees or RF_TREES, SEED, max_depth, **growth)
    trees, max_depth, max_bins = trees or RF_TREES, max_depth or RF_MAX_DEPTH, max_bins or RF_MAX_BINS
    return Pipeline(stages=[
        VectorAssembler(inputCols=feats, outputCol="features"),
        RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=trees,
                              featureSubsetStrategy="all", maxDepth=max_depth, maxBins=max_bins,
                              seed=SEED, **TREE_RUNTIME)])


def gradient_boosting(features=None, rounds: int | None = None) -> Pipeline:
    """M05 (default rounds: the module setting at call time)."""
    feats = list(features or S.FEATURE_COLS)
    rounds = rounds or GBT_ROUNDS
    return Pipeline(stages=[
        VectorAssembler(inputCols=feats, outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol=LABEL, maxIter=rounds, stepSize=0.1, maxDepth=3,
                     seed=SEED, **TREE_RUNTIME)])


def least_squares(features=None, degree: int = 1) -> LeastSquares:
    """M02/M03 where only errors or predictions are asked for: solved from moment matrices."""
    return LeastSquares(tuple(features or BASE_COLS), degree)


# The reference's model names.
def model_set(poly_degree: int = 2, with_boosting: bool = False, forest: dict | None = None) -> dict:
    models = {"Linear Regression": least_squares(),
              "Polynomial Regression": least_squares(degree=poly_degree),
              "Random Forest": random_forest(**(forest or {}))}
    if with_boosting:
        models["Gradient Boosting"] = gradient_boosting()
    return models


# --------------------------------------------------------------------------- M06: metrics

def metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction", digits=(3, 3, 4)) -> DataFrame:
    """MAE (3 digits), RMSE (3), R² (4) in one aggregate over the scored rows."""
    e = F.col(prediction) - F.col(label)
    stats = pred.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                     F.sum(e * e).alias("sse"), F.var_pop(label).alias("var"), F.count(F.lit(1)).alias("n"))
    return stats.select(F.round("mae", digits[0]).alias("mae"), F.round(F.sqrt("mse"), digits[1]).alias("rmse"),
                        F.round(1 - F.try_divide(F.col("sse"), F.col("var") * F.col("n")), digits[2]).alias("r2"))


def _mae(pred: DataFrame) -> float:
    return pred.agg(F.avg(F.abs(F.col("prediction") - F.col(LABEL)))).first()[0]


# --------------------------------------------------------------------------- M08-M11

PARALLEL_FITS = 4


def _in_parallel(tasks, parallelism: int = PARALLEL_FITS) -> list:
    """Run independent fits concurrently (each is its own set of Spark jobs), as
    ``CrossValidator(parallelism=…)`` does; results come back in task order."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda t: t(), tasks))



def _kept(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` kept for the many passes of a fit, dealt once over ``partitions`` tasks by the row's hash.

    None keeps the frame's own partitions, which follow the size of the data wherever it has many scan splits.
    """
    if partitions:
        df = df.repartition(partitions, _row_hash(df, None, 0))
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _split(prepared, partitions: int | None = None, fits=()):
    """The hold-out split of a prepared frame (or of the one stored at a path), kept for the passes of a fit.

    Where ``fits`` are forests grown to purity alone it is not kept: they store the training rows themselves.
    """
    tagged = holdout(as_frame(prepared))
    if partitions or not fits or not all(isinstance(f, PureForest) for f in fits):
        tagged = _kept(tagged, partitions)
    return tagged, tagged.filter(~F.col("is_test")), tagged.filter(F.col("is_test"))


def _test_scores(model, test: DataFrame) -> DataFrame:
    """The scored test rows; a forest grown to purity stores what it scores, so it gets only the columns it needs."""
    if isinstance(model, PureForestModel):
        test = test.select(*model.features, LABEL)
    return model.transform(test)


def _solved_and_others(models: dict) -> tuple[dict, dict]:
    solved = {n: e for n, e in models.items() if isinstance(e, LeastSquares)}
    return solved, {n: e for n, e in models.items() if n not in solved}


def compare_models(spark: SparkSession, prepared, poly_degree: int = 2, forest: dict | None = None, models: dict | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Linear, polynomial and forest (or ``models``) on one hold-out split → ``(model_name, mae, rmse, r2)``."""
    models = models or model_set(poly_degree, forest=forest)
    tagged, train, test = _split(prepared, partitions, models.values())
    solved, others = _solved_and_others(models)

    def run(name, est):
        m = metrics(_test_scores(est.fit(train), test)).first()
        return name, m["mae"], m["rmse"], m["r2"]

    try:
        rows = _in_parallel([lambda n=n, e=e: run(n, e) for n, e in others.items()])
        if solved:
            rows += [(n, *[None if x is None else round(float(x), d) for x, d in zip(m, (3, 3, 4))]) for n, m in held_out(tagged, solved).items()]
    finally:
        tagged.unpersist()
    out = spark.createDataFrame(rows, "model_name string, mae double, rmse double, r2 double")
    return out.orderBy("mae", "model_name")


def compare_models_cv(spark: SparkSession, prepared, poly_degree: int = 2, k: int = 5,
                      parallelism: int = 2 * PARALLEL_FITS, forest: dict | None = None, models: dict | None = None,
                      partitions: int | None = None) -> DataFrame:
    """K-fold mean MAE of the four models (or of ``models``) → ``(model_name, mae)``.

    Least-squares models are solved together from moment matrices by fold.  Every other (model, fold) fit is
    independent, so they run concurrently over one cached copy of the folded rows; a model's score is
    the mean of its fold MAEs, as in the reference.
    """
    folded = _kept(with_folds(as_frame(prepared), k), partitions)
    models = models or model_set(poly_degree, with_boosting=True, forest=forest)
    solved, others = _solved_and_others(models)

    def run(name, est, i):
        fold = F.col("fold") == i
        return name, _mae(est.fit(folded.filter(~fold)).transform(folded.filter(fold)))

    try:
        scores = _in_parallel([lambda n=n, e=e, i=i: run(n, e, i) for n, e in others.items() for i in range(k)],
                              parallelism)
        rows = [(name, round(float(sum(m for n, m in scores if n == name)) / k, 3)) for name in others]
        if solved:
            rows += [(name, round(float(mae), 3)) for name, mae in cross_validated(folded, solved).items()]
    finally:
        folded.unpersist()
    return spark.createDataFrame(rows, "model_name string, mae double").orderBy("mae", "model_name")


def progressive_accuracy(spark: SparkSession, prepared, forest: dict | None = None, estimator=None, partitions: int | None = None) -> DataFrame:
    """A forest per prefix of splits (50 m … 250 m) → ``(splits_used, n_features, mae)``.

    ``estimator(features)``: another model than the forest; least-squares ones are solved together.
    """
    make = estimator or (lambda feats: random_forest(feats, **(forest or {})))
    tagged, train, test = _split(prepared, partitions)
    made = {splits[-1]: make(build_features(splits)) for splits in PROGRESSIVE_SPLITS}
    solved, others = _solved_and_others(made)

    def run(splits):
        if splits[-1] in solved:
            return None
        return _mae(others[splits[-1]].fit(add_intervals(train, splits)).transform(add_intervals(test, splits)))

    try:
        maes = dict(zip(made, _in_parallel([lambda s=s: run(s) for s in PROGRESSIVE_SPLITS])))
        if solved:
            maes |= {name: m[0] for name, m in held_out(add_intervals(tagged, S.FEATURE_SPLITS), solved).items()}
    finally:
        tagged.unpersist()
    rows = [(s[-1], len(build_features(s)), round(float(maes[s[-1]]), 3)) for s in PROGRESSIVE_SPLITS]
    return spark.createDataFrame(rows, "splits_used string, n_features int, mae double")


def importances_of(model) -> list[float]:
    """The importances of a fitted forest, in feature order."""
    return list(model.importances if isinstance(model, PureForestModel) else model.stages[-1].featureImportances.toArray())


def train_model(spark: SparkSession, prepared, forest: dict | None = None, partitions: int | None = None):
    """Forest on the hold-out split → (model, test MAE, importances frame)."""
    estimator = random_forest(**(forest or {}))
    tagged, train, test = _split(prepared, partitions, [estimator])
    try:
        model = estimator.fit(train)
        mae = float(_mae(_test_scores(model, test)))
    finally:
        tagged.unpersist()
    return model, mae, importances_frame(spark, S.FEATURE_COLS, importances_of(model))


# --------------------------------------------------------------------------- M12, M13: scoring

def predict_batch(model: PipelineModel, prepared: DataFrame) -> DataFrame:
    """Adds ``predicted_time`` and ``residual`` (predicted − actual)."""
    prepared = as_frame(prepared)
    require_columns(prepared, S.FEATURE_COLS + [LABEL], "prepared frame")
    out = model.transform(prepared)
    drop = [c for c in out.columns if c not in prepared.columns]
    return (out.withColumn("predicted_time", F.col("prediction"))
            .withColumn("residual", F.col("predicted_time") - F.col(LABEL))
            .drop(*drop))


def predict(model: PipelineModel, splits: DataFrame) -> DataFrame:
    """M12, batch form: rows of splits (seconds or ``M:SS.ss`` text) → ``predicted_time`` (2 digits).

    A missing or unreadable reaction time takes the fixed default 0.72 s.  A
    row with a missing or unreadable split has no prediction (NULL); no row is dropped.
    """
    df = splits
    for c in S.FEATURE_SPLITS:
        numeric = dict(df.dtypes)[c] != "string"
        df = df.withColumn(c, F.col(c) if numeric else time_to_seconds(F.col(c), "ingest"))
    reaction = to_double(F.col("reaction_time")) if "reaction_time" in df.columns else F.lit(None).cast("double")
    df = df.withColumn("reaction_time", F.coalesce(reaction, F.lit(S.DEFAULT_REACTION)))
    df = add_intervals(df)
    used = [*S.FEATURE_SPLITS, *S.INTERVAL_COLS]
    missing = F.lit(False)
    for c in S.FEATURE_SPLITS:
        missing = missing | F.col(c).isNull() | F.isnan(c)
    row = F.struct(*[F.col(c) for c in df.columns])
    filled = df.select(row.alias("_row"), missing.alias("_missing"), "reaction_time",
                       *[F.when(missing, 0.0).otherwise(F.col(c)).alias(c) for c in used])
    out = model.transform(filled)
    return out.select("_row.*", F.when(~F.col("_missing"), F.round("prediction", 2)).alias("predicted_time"))


# --------------------------------------------------------------------------- OLS with a closed-form check

def ols_single(spark: SparkSession, prepared: DataFrame, feature: str = "split_250m") -> DataFrame:
    """One-feature least squares fitted with pyspark.ml, with in-sample metrics (4 digits)."""
    model = linear_regression([feature]).fit(prepared)
    lr = model.stages[-1]
    return metrics(model.transform(prepared), digits=(4, 4, 4)).select(
        F.lit(feature).alias("feature"),
        F.round(F.lit(float(lr.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(lr.intercept)), 4).alias("intercept"), "mae", "rmse", "r2")


def ols_pair(spark: SparkSession, prepared: DataFrame, f1: str = "split_250m",
             f2: str = "reaction_time") -> DataFrame:
    """Two-feature least squares fitted with pyspark.ml, with in-sample metrics (4 digits)."""
    model = linear_regression([f1, f2]).fit(prepared)
    lr = model.stages[-1]
    return metrics(model.transform(prepared), digits=(4, 4, 4)).select(
        F.round(F.lit(float(lr.coefficients[0])), 4).alias(f"b_{f1}"),
        F.round(F.lit(float(lr.coefficients[1])), 4).alias(f"b_{f2}"),
        F.round(F.lit(float(lr.intercept)), 4).alias("intercept"), "mae", "rmse", "r2")


def _inputs(estimators, frame: DataFrame) -> list[str]:
    """The columns of the frame that the stages of the estimators name, or all where a stage is of another kind."""
    stages = [s for e in estimators for s in (e.getStages() if isinstance(e, Pipeline) else [e])]
    if not all(isinstance(s, (VectorAssembler, StandardScaler, PolynomialExpansion, LinearRegression, RandomForestRegressor, GBTRegressor)) for s in stages):
        return frame.columns
    named = [v for s in stages for v in s.extractParamMap().values()]
    return [c for c in frame.columns if any(c == v or isinstance(v, list) and c in v for v in named)]


def holdout_metrics(prepared, estimators: dict) -> DataFrame:
    """M08's measure for any set of estimators: each fitted on the training rows, measured on the test rows.

    The columns that the models read are stored once in the shared folder, as there are two passes a model: no executor
    has to hold rows, whatever their number.
    """
    tagged = holdout(as_frame(prepared))
    spark = tagged.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapline-holdout-{uuid.uuid4().hex}"
    narrow = tagged.select(*dict.fromkeys([*_inputs(estimators.values(), tagged), LABEL, "is_test"]))
    narrow.write.parquet(path)
    narrow = spark.read.schema(narrow.schema).parquet(path)
    train, test = narrow.filter(~F.col("is_test")), narrow.filter(F.col("is_test"))
    rows = [(name, *metrics(est.fit(train).transform(test)).first()) for name, est in estimators.items()]
    return spark.createDataFrame(rows, "model_name string, mae double, rmse double, r2 double")


# --------------------------------------------------------------------------- A07: example prediction

# The reference's example swimmer (seconds).
EXAMPLE_SPLITS = {"split_50m": 26.69, "split_100m": 55.38, "split_150m": 83.74,
                  "split_200m": 112.53, "split_250m": 140.97, "reaction_time": 0.73}


def prediction_example(spark: SparkSession, model: PipelineModel, predict_fn=None,
                       example: dict | None = None) -> DataFrame:
    """One example row through ``predict_fn`` (default M12), with the formatted time."""
    from lapline.functions.times import format_seconds
    row = dict(example or EXAMPLE_SPLITS)
    cols = list(row)
    df = spark.createDataFrame([tuple(float(row[c]) for c in cols)], ", ".join(f"{c} double" for c in cols))
    out = (predict_fn or predict)(model, df)
    return out.select("predicted_time", format_seconds(F.col("predicted_time")).alias("formatted"))
