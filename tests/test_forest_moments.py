"""The forest grown to purity, least squares from moments, exact quantiles: against plain forms."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapline import schema as S
from lapline.functions.quantile import exact_quantile
from lapline.operators import clean as C
from lapline.operators import gram as G
from lapline.operators import model as M
from lapline.operators.forest import PureForest, Tree, bootstrap_weights, grow


def _plain(x, y, w, depth=None):
    """A recursive tree: (feature, threshold, left, right) or the value of a leaf."""
    mean = np.average(y, weights=w)
    if len(set(y.tolist())) == 1 or depth == 0:
        return mean
    best = None
    for f in range(x.shape[1]):
        seen = np.unique(x[:, f])
        for a, b in zip(seen[:-1], seen[1:]):
            low = x[:, f] <= a
            centred = y - mean
            gain = (w * centred)[low].sum() ** 2 / w[low].sum() + (w * centred)[~low].sum() ** 2 / w[~low].sum()
            if best is None or gain > best[0] + 1e-9:
                best = gain, f, a + (b - a) / 2
    if best is None:
        return mean
    low, less = x[:, best[1]] <= best[2], None if depth is None else depth - 1
    return best[1], best[2], _plain(x[low], y[low], w[low], less), _plain(x[~low], y[~low], w[~low], less)


def _same(tree, plain, i=0):
    if isinstance(plain, tuple):
        return tree.feature[i] == plain[0] and math.isclose(tree.threshold[i], plain[1], abs_tol=1e-9) \
            and _same(tree, plain[2], tree.left[i]) and _same(tree, plain[3], tree.left[i] + 1)
    return tree.feature[i] < 0 and math.isclose(tree.value[i], plain, abs_tol=1e-9)


@pytest.mark.parametrize("depth", [None, 1, 3])
def test_grown_tree_is_the_recursive_one(depth):
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = rng.integers(1, 60)
        x, w = np.round(rng.normal(size=(n, 3)), 1), rng.integers(1, 4, n).astype(float)
        y = (rng.integers(0, 6, n) ** 2 + rng.normal(size=n)).round(1)
        tree, gains = grow(x, y, w, depth)
        assert _same(tree, _plain(x, y, w, depth))
        back = Tree.unpack(tree.pack())
        assert (back.leaves(x) == tree.leaves(x)).all() and (gains >= 0).all()


def _swims(spark, n=1500):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        pace = 26 + rng.random() * 4
        splits = [round(pace * k + rng.random(), 2) for k in range(1, 6)]
        rows.append((f"r{i}", round(0.6 + rng.random() / 5, 2), *splits, round(pace * 8.3 + 3 * math.sin(3 * pace) + rng.random(), 2)))
    df = spark.createDataFrame(rows, "Link string, reaction_time double, " + ", ".join(f"{c} double" for c in S.FEATURE_SPLITS) + ", final_time double")
    return C.add_intervals(df)


@pytest.mark.parametrize("small", [100_000, 200])
def test_forest_over_the_cluster_fits_its_rows(spark, small):
    """Every row drawn once: a tree grown to purity gives each training row its own label, with and without a top phase."""
    df = _swims(spark).repartition(3)
    model = PureForest(S.FEATURE_COLS, trees=2, bootstrap=False, small_rows=small, bins=16).fit(df)
    tops = [len(t.feature) for t in model.tops]
    assert tops == [1, 1] if small > 1500 else min(tops) > 7
    scored = model.transform(df.withColumn("extra", F.lit("kept")))
    assert scored.columns == [*df.columns, "extra", "prediction"] and scored.count() == 1500
    assert scored.filter(F.abs(F.col("prediction") - F.col("final_time")) > 1e-9).count() == 0
    assert abs(sum(model.importances) - 1) < 1e-9


def test_top_phase_splits_as_the_bottom_does(spark):
    """A step in the labels is found by the histograms of the top phase, at a threshold between the same values."""
    df = spark.range(4000).select((F.col("id") % 40).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                  F.when(F.col("id") % 40 < 13, 1.0).otherwise(5.0).alias("y"))
    model = PureForest(["a", "b"], "y", trees=1, bootstrap=False, small_rows=10, bins=100).fit(df)
    top = model.tops[0]
    assert top.feature.tolist() == [0, -1, -1] and 12 <= top.threshold[0] < 13 and top.value.tolist()[1:] == [1.0, 5.0]


def test_forest_depth_is_no_cap(spark):
    """Hold-out error no worse than the same forest of depth 10, and trees deeper than that."""
    df = _swims(spark, 3000)
    tagged = M.holdout(df)
    train, test = tagged.filter("NOT is_test"), tagged.filter("is_test")
    pure = M.random_forest(pure=True, trees=10).fit(train)
    deep = M._mae(pure.transform(test))
    shallow = M._mae(M.random_forest(pure=True, trees=10, max_depth=10).fit(train).transform(test))
    level = M._mae(M.random_forest(trees=10, max_depth=10).fit(train).transform(test))
    assert deep <= shallow * 1.02 and deep <= level * 1.02

    def depth(tree, i=0):
        return 0 if tree.feature[i] < 0 else 1 + max(depth(tree, tree.left[i]), depth(tree, tree.left[i] + 1))

    assert max(depth(Tree.unpack(r["packed"])) for r in pure.subtrees(spark).collect()) > 10


def test_forest_of_odd_rows(spark):
    df = _swims(spark, 30)
    odd = df.unionByName(df.limit(3).withColumn("split_50m", F.lit(None).cast("double"))).unionByName(df.limit(2).withColumn("final_time", F.lit(float("nan"))))
    model = PureForest(S.FEATURE_COLS, trees=3).fit(odd)
    scored = model.transform(odd)
    assert scored.count() == 35 and scored.filter("prediction IS NULL").count() == 3
    assert M.predict(model, df.select(*S.FEATURE_SPLITS, "reaction_time")).filter("predicted_time IS NULL").count() == 0
    none = PureForest(S.FEATURE_COLS, trees=2).fit(df.limit(0))
    assert none.transform(df).count() == 30


def test_bootstrap_is_poisson_and_stable():
    w = bootstrap_weights(np.arange(200_000), 3, 42)
    assert abs(w.mean() - 1) < 0.02 and abs((w == 0).mean() - math.exp(-1)) < 0.01 and (w == bootstrap_weights(np.arange(200_000), 3, 42)).all()
    assert (w != bootstrap_weights(np.arange(200_000), 4, 42)).mean() > 0.5


@pytest.mark.parametrize(("features", "degree"), [(M.BASE_COLS, 1), (M.BASE_COLS, 2), (["split_250m"], 3)])
def test_moments_give_the_least_squares_fit(spark, features, degree):
    df = M.with_folds(M.holdout(_swims(spark)))
    rows = df.select(*features, "final_time", "fold", "is_test").toPandas()
    x = rows[features].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    from itertools import combinations_with_replacement as combos
    z = np.column_stack([np.ones(len(x)), *[np.prod(x[:, list(t)], axis=1) for d in range(1, degree + 1) for t in combos(range(len(features)), d)]])
    y, spec = rows["final_time"].to_numpy(), M.least_squares(features, degree)

    def errors(test):
        return z[test] @ np.linalg.lstsq(z[~test], y[~test], rcond=None)[0] - y[test]

    e = errors(rows["is_test"].to_numpy())
    mae, rmse, r2 = G.held_out(df, {"m": spec})["m"]
    assert np.allclose([mae, rmse], [abs(e).mean(), (e @ e / len(e)) ** 0.5], rtol=1e-6) and r2 > 0.5
    folds = rows["fold"].to_numpy()
    assert math.isclose(G.cross_validated(df, {"m": spec, "other": M.least_squares()})["m"], np.mean([abs(errors(folds == f)).mean() for f in sorted(set(folds))]), rel_tol=1e-6)
    got = spec.fit(df).transform(df)
    assert abs(M._mae(got) - abs(z @ np.linalg.lstsq(z, y, rcond=None)[0] - y).mean()) < 1e-6


def test_moments_with_a_constant_and_a_repeated_feature(spark):
    df = _swims(spark, 200).withColumn("same", F.lit(3.0)).withColumn("again", F.col("split_50m") * 2 + 1)
    a = M.least_squares(["split_50m"]).fit(df).transform(df)
    b = M.least_squares(["split_50m", "same", "again"]).fit(df).transform(df)
    assert abs(M._mae(a) - M._mae(b)) < 1e-9


def test_jobs_do_not_grow_with_models(spark):
    df = M.with_folds(_swims(spark, 300)).cache()
    df.count()
    tracker = spark.sparkContext.statusTracker()

    def jobs(models):
        spark.sparkContext.setJobGroup(f"cv-{len(models)}", "")
        G.cross_validated(df, models)
        found = len(tracker.getJobIdsForGroup(f"cv-{len(models)}"))
        spark.sparkContext._jsc.clearJobGroup()
        return found

    one = jobs({"a": M.least_squares()})
    assert jobs({f"m{i}": M.least_squares(S.FEATURE_SPLITS[: i + 1], 1 + i % 2) for i in range(5)}) == one


@pytest.mark.parametrize("values", [[], [1.5], [2.0, 1.0], [1.0] * 9 + [7.0], [1e308, -1e308, 0.0, 5e-324, 1.0], [float(i) ** 3 for i in range(-50, 51)]])
def test_exact_quantile(spark, monkeypatch, values):
    from lapline.functions import quantile
    monkeypatch.setattr(quantile, "BUCKETS", 4)
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan"), float("inf")]], "v double")
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        want = float(np.quantile(values, q)) if values else None
        got = exact_quantile(df, F.col("v"), q)
        assert got == want or math.isclose(got, want, rel_tol=1e-12)


def test_exact_median_of_many_distinct_values(spark):
    rng = np.random.default_rng(3)
    values = rng.lognormal(0, 8, 20_001)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert exact_quantile(df, F.col("v")) == float(np.median(values))
    filled = C.impute_median(df.unionByName(spark.createDataFrame([(None,)], "v double")), "v")
    assert filled.filter(F.col("v") == float(np.median(values))).count() == 2


def test_forest_that_ends_in_its_tops_scores_in_one_pass(spark):
    """Nothing is stored or shuffled for trees without subtrees, and the scores are the leaves' means."""
    df = _swims(spark).withColumn("note", F.lit("kept"))
    model = PureForest(S.FEATURE_COLS, trees=3, max_depth=1, small_rows=200, bins=16).fit(df)
    assert model.subtrees(spark).isEmpty() and [len(t.feature) for t in model.tops] == [3, 3, 3]
    odd = df.unionByName(df.limit(2).withColumn("split_50m", F.lit(None).cast("double")))
    scored = model.transform(odd)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "lapline-scored" not in plan and "Join" not in plan and "Aggregate" not in plan
    rows = scored.collect()
    assert scored.columns == [*df.columns, "prediction"] and len(rows) == 1502 and sum(r.prediction is None for r in rows) == 2
    for r in rows[:50]:
        x = np.array([[r[c] for c in S.FEATURE_COLS]])
        assert abs(r.prediction - np.mean([t.value[t.leaves(x)][0] for t in model.tops])) < 1e-9


def test_forest_with_and_without_subtrees(spark):
    """Scores are the same where some trees end in their tops and others go on below."""
    df = _swims(spark, 900).withColumn("final_time", F.when(F.col("split_50m") < 28, 100.0).otherwise(F.col("final_time")))
    model = PureForest(S.FEATURE_COLS, trees=3, small_rows=200, bins=64).fit(df)
    below = {(r["tree"], r["node"]): Tree.unpack(r["packed"]) for r in model.subtrees(spark).collect()}
    ends = {(t, int(n)) for t, top in enumerate(model.tops) for n in np.flatnonzero(top.feature < 0)}
    assert below and ends - set(below)
    for r in model.transform(df).collect()[:100]:
        x = np.array([[r[c] for c in S.FEATURE_COLS]])
        values = []
        for t, top in enumerate(model.tops):
            node = int(top.leaves(x)[0])
            sub = below.get((t, node))
            values.append(sub.value[sub.leaves(x)][0] if sub else top.value[node])
        assert abs(r.prediction - np.mean(values)) < 1e-9


def test_rows_of_pure_forests_are_not_cached(spark):
    df = _swims(spark, 60)
    assert not M._split(df, None, [M.random_forest(pure=True)])[0].storageLevel.useMemory
    tagged = M._split(df, None, [M.random_forest(trees=2)])[0]
    assert tagged.storageLevel.useMemory
    tagged.unpersist()


def _odd_values(rng, n):
    """Noise, steps, few values, far outliers, a constant and a copy: what equal bins tell apart badly or not at all."""
    a, far = rng.normal(size=n).round(2), rng.normal(size=n)
    far[:3] = 1e9, -1e12, 1e300
    x = np.column_stack([a, rng.normal(size=n), far, rng.integers(0, 4, n), np.full(n, 7.0), a, np.exp(rng.normal(size=n) * 20)])
    y = 3.0 * (far > 0.1234) + (x[:, 3] == 2) + rng.normal(size=n).round(3)
    return x, y


@pytest.mark.parametrize("depth", [1, 4, None])
def test_splits_do_not_depend_on_the_size_switch(spark, depth):
    """The splits of the top phase are those of ``grow`` over the same rows, whatever the bins."""
    x, y = _odd_values(np.random.default_rng(5), 1200)
    names = [f"c{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"{c} double" for c in [*names, "y"])).repartition(3)
    want, gains = grow(x, y, np.ones(len(y)), depth)
    for bins in (4, 128):
        model = PureForest(names, "y", trees=1, bootstrap=False, small_rows=40, bins=bins, max_depth=depth).fit(df)
        assert len(model.tops[0].feature) > 1
        got = {tuple(r[c] for c in names): r["prediction"] for r in model.transform(df).collect()}
        assert np.allclose([got[tuple(r)] for r in x.tolist()], want.value[want.leaves(x)], rtol=0, atol=1e-9)
        assert np.allclose(model.importances, gains / gains.sum(), atol=1e-9)
    if depth == 1:
        top = model.tops[0]
        assert top.feature.tolist() == want.feature.tolist() and top.threshold.tolist() == want.threshold.tolist() and top.feature[0] == 2


def test_drawn_forest_does_not_depend_on_the_size_switch(spark):
    df = _swims(spark, 900)
    small, large = [PureForest(S.FEATURE_COLS, trees=3, small_rows=s, bins=8).fit(df) for s in (100_000, 50)]
    assert [len(t.feature) for t in small.tops] == [1, 1, 1] and min(len(t.feature) for t in large.tops) > 20
    a, b = [{r["Link"]: r["prediction"] for r in m.transform(df).collect()} for m in (small, large)]
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9 and np.allclose(small.importances, large.importances, atol=1e-9)


def test_small_nodes_are_spread_over_tasks(spark):
    """The work on a node does not follow its bytes, so its tasks are not put together by them."""
    rows = _swims(spark, 200).select(*[F.col(c).alias(f"x{j}") for j, c in enumerate(S.FEATURE_COLS)], F.col("final_time").alias("y"), F.xxhash64("Link").alias("r"))
    roots = [Tree(np.array([-1]), np.zeros(1), np.zeros(1, np.int64), np.zeros(1)) for _ in range(8)]
    grown = PureForest(S.FEATURE_COLS, trees=8)._bottoms(rows, roots, [(t, 0) for t in range(8)], len(S.FEATURE_COLS), {})
    found = grown.select("tree", F.spark_partition_id().alias("task")).collect()
    assert sorted(r["tree"] for r in found) == list(range(8)) and len({r["task"] for r in found}) > 2


def test_rows_of_a_large_tree_end_in_their_leaves():
    """Rows are renumbered while a tree grows: each leaf still has the mean of its rows, and rows told apart their own label."""
    rng = np.random.default_rng(8)
    x, w = rng.normal(size=(3000, 3)), rng.integers(1, 4, 3000).astype(float)
    y = np.where(x[:, 0] > 0, 5.0, rng.normal(size=3000))
    x[:50], y[:50] = x[0], rng.normal(size=50)
    tree, gains = grow(x, y, w)
    at = tree.leaves(x)
    assert (tree.feature[at] < 0).all() and len(set(at.tolist())) > 1000
    assert np.allclose(tree.value[at[50:]], y[50:]) and np.allclose(tree.value[at[:50]], np.average(y[:50], weights=w[:50]))
    mean = np.average(y, weights=w)
    assert math.isclose(gains.sum(), (w * (y - mean) ** 2).sum() - (w * (y - tree.value[at]) ** 2).sum(), rel_tol=1e-9)


def test_splits_do_not_depend_on_the_waves(spark, monkeypatch):
    """The same splits where the bins of one node, or of one round, do not go into one pass."""
    from lapline.operators import forest
    x, y = _odd_values(np.random.default_rng(6), 600)
    names = [f"c{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"{c} double" for c in [*names, "y"])).repartition(2)
    want, _ = grow(x, y, np.ones(len(y)), 2)
    monkeypatch.setattr(forest, "WAVE_CELLS", 24)
    monkeypatch.setattr(forest, "WAVE_NODES", 1)
    top = PureForest(names, "y", trees=1, bootstrap=False, small_rows=60, bins=8, max_depth=2).fit(df).tops[0]
    assert top.feature.tolist() == want.feature.tolist() and top.threshold.tolist() == want.threshold.tolist()
    assert np.allclose(top.value, want.value)
