"""Patience, losses by round and contributions of boosted trees, against plain Python."""

import itertools
import math
import uuid

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from saleslens.plans import boosting as B


def test_best_round_has_patience():
    fall_rise_fall = [5.0, 4.0, 4.5, 4.6, 4.4, 3.0, 3.5, 3.6, 3.7]
    assert B.best_round(fall_rise_fall, 1) == (2, True)
    assert B.best_round(fall_rise_fall, 3) == (2, True)
    assert B.best_round(fall_rise_fall, 4) == (6, False)  # the rise is sat out
    assert B.best_round(fall_rise_fall, 100) == (6, False)
    assert B.best_round([3.0, 3.0, 3.0], 2) == (1, True)


def stump(feature, cut, low, high, n_low, n_high):
    return B.Tree(np.array([feature, 0, 0]), np.array([cut, 0.0, 0.0]), np.array([1, -1, -1]), np.array([2, -1, -1]),
                  np.array([0.0, low, high]), np.array([n_low + n_high, n_low, n_high]))


def random_tree(rng, features, depth):
    """Splits may use a feature again, also with a bound that nothing passes."""
    cols = [[], [], [], [], [], []]

    def grow(d, cover):
        at = len(cols[0])
        for c, v in zip(cols, (0, 0.0, -1, -1, float(rng.normal()), float(cover))):
            c.append(v)
        if d and rng.random() < 0.9:
            cols[0][at], cols[1][at] = int(rng.integers(features)), float(rng.normal())
            part = float(rng.uniform(0.1, 0.9))
            cols[2][at] = grow(d - 1, cover * part)
            cols[3][at] = grow(d - 1, cover * (1 - part))
        return at

    grow(depth, 100.0)
    return B.Tree(*map(np.array, cols))


def expected(tree, row, known):
    """The expected score of a walk that knows only some features."""

    def at(node):
        if tree.left[node] < 0:
            return tree.value[node]
        left, right = int(tree.left[node]), int(tree.right[node])
        if int(tree.feature[node]) in known:
            return at(left if row[tree.feature[node]] <= tree.threshold[node] else right)
        share = tree.cover[left] / tree.cover[node]
        return share * at(left) + (1 - share) * at(right)

    return at(0)


def shapley(ensemble, row):
    n = len(ensemble.features)
    value = {}
    for k in range(n + 1):
        for s in itertools.combinations(range(n), k):
            value[frozenset(s)] = sum(w * expected(t, row, set(s)) for w, t in zip(ensemble.weights, ensemble.trees))
    out = []
    for j in range(n):
        total = 0.0
        for k in range(n):
            for s in itertools.combinations([i for i in range(n) if i != j], k):
                total += math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) * (value[frozenset(s) | {j}] - value[frozenset(s)])
        out.append(total)
    return out, value[frozenset()]


def test_contributions_are_shapley_values():
    rng = np.random.default_rng(1)
    ensemble = B.Ensemble(list("abcd"), [random_tree(rng, 4, 4) for _ in range(5)], rng.uniform(0.1, 1, 5))
    x = rng.normal(size=(30, 4))
    x[3, 1] = np.nan
    parts, base = ensemble.contributions(x)
    np.testing.assert_allclose(parts.sum(axis=1) + base, ensemble.score(x), atol=1e-9)
    for i in range(30):
        want, start = shapley(ensemble, x[i])
        np.testing.assert_allclose(parts[i], want, atol=1e-9)
        assert base == pytest.approx(start)


def panel(spark, n=800, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, float(a), float(b), float(c), float(3 * a + np.sin(3 * b) + rng.normal(0, 0.3)), float(1 + (i % 3)))
            for i, (a, b, c) in enumerate(rng.normal(size=(n, 3)))]
    return spark.createDataFrame(rows, "i int, a double, b double, c double, y double, w double")


def test_node_table_scores_like_the_library(spark):
    df = panel(spark)
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="_x").transform(df)
    model = GBTRegressor(featuresCol="_x", labelCol="y", maxIter=6, maxDepth=3, seed=1).fit(ready)
    ensemble = B.ensemble_of(model, ["a", "b", "c"], spark)
    got = B.TreeModel(ensemble, []).predict(df, "p").orderBy("i").toPandas()["p"]
    np.testing.assert_allclose(got, model.transform(ready).orderBy("i").toPandas()["prediction"], rtol=1e-12)
    losses = B.round_losses(ensemble, df, "y", None)
    np.testing.assert_allclose(losses, model.evaluateEachIteration(ready, "squared"), rtol=1e-9)


def test_holdout_cuts_the_ensemble_at_its_best_round(spark):
    df = panel(spark)
    held = F.col("i") % 4 == 0
    # Labels of a few training rows are wrong by far: late rounds fit them and the holdout loss rises.
    noisy = df.withColumn("y", F.when((F.col("i") % 25 == 1), F.col("y") + 40).otherwise(F.col("y")))
    model = B.fit_trees(noisy, ["a", "b", "c"], "y", is_eval=held, weight="w", rounds=40, depth=5, step=0.5, patience=5)
    keep, ended = B.best_round(model.losses, 5)
    assert ended and len(model.ensemble.trees) == keep < len(model.losses) and model.losses[-1] > model.losses[keep - 1]
    x = noisy.where(held).toPandas()
    error = np.average((x["y"] - model.ensemble.score(x[["a", "b", "c"]].to_numpy())) ** 2, weights=x["w"])
    assert error == pytest.approx(model.losses[keep - 1])
    again = B.fit_trees(noisy, ["a", "b", "c"], "y", is_eval=held, weight="w", rounds=40, depth=5, step=0.5, patience=5)
    assert again.losses == pytest.approx(model.losses)


def test_fits_are_made_longer_until_patience_ends_them(spark):
    df = panel(spark, 300)
    model = B.fit_trees(df, ["a", "b"], "y", is_eval=F.col("i") % 3 == 0, rounds=12, depth=2, step=0.05, patience=2)
    assert len(model.losses) == 12  # 3, 6, 12: every round still gained
    no_holdout = B.fit_trees(df, ["a", "b"], "y", rounds=4, depth=2)
    assert len(no_holdout.ensemble.trees) == 4 and no_holdout.losses == []
    empty_holdout = B.fit_trees(df, ["a", "b"], "y", is_eval=F.lit(False), rounds=4, depth=2)
    assert len(empty_holdout.ensemble.trees) == 4


def test_importance_is_the_mean_absolute_contribution(spark):
    df = panel(spark)
    model = B.fit_trees(df, ["c", "a", "b"], "y", rounds=8, depth=3)
    sample = B.hashed_sample(df, 100, ["i"])
    assert sample.count() == 100 and sorted(r.i for r in sample.collect()) == sorted(r.i for r in B.hashed_sample(df.repartition(5), 100, ["i"]).collect())
    rows = model.contributions(sample).collect()
    for r in rows:
        assert sum(r.parts) + r.base == pytest.approx(r.prediction)
    mean = dict(zip(["c", "a", "b"], np.abs([r.parts for r in rows]).mean(axis=0)))
    got = [(r["rank"], r.feature, r.importance) for r in model.importance(sample, 2).collect()]
    assert [g[:2] for g in got] == [(1, "a"), (2, "b")]
    assert all(v == pytest.approx(mean[f]) for _, f, v in got)


def test_tree_leaves_partition_the_rows():
    tree = stump(1, 0.5, 2.0, 3.0, 30, 10)
    leaves = {v: p for v, p in tree.leaves()}
    assert leaves == {2.0: {1: (-math.inf, 0.5, 0.75)}, 3.0: {1: (0.5, math.inf, 0.25)}}


def jobs_of(spark, run):
    """(result, number of jobs) of what this thread runs."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("block_rows", [50_000, 150])
def test_trees_are_those_of_the_library(spark, monkeypatch, block_rows):
    """In one block and in several; with weights, few values and a value that is most rows'."""
    monkeypatch.setattr(B, "BLOCK_ROWS", block_rows)
    df = panel(spark, 700).withColumns({
        "d": (F.col("i") % 4).cast("double"), "e": F.when(F.col("b") > 0, F.floor(F.col("b") * 30)).otherwise(0.0)})
    features = ["a", "b", "c", "d", "e"]
    model = B.fit_trees(df, features, "y", weight="w", rounds=7, depth=4, step=0.2)
    ready = VectorAssembler(inputCols=features, outputCol="_x").transform(df)
    library = GBTRegressor(featuresCol="_x", labelCol="y", weightCol="w", maxIter=7, maxDepth=4, stepSize=0.2, seed=1).fit(ready)
    want = library.transform(ready).orderBy("i").toPandas()["prediction"]
    np.testing.assert_allclose(model.predict(df, "p").orderBy("i").toPandas()["p"], want, rtol=1e-9)
    assert model.ensemble.trees[0].cover[0] == pytest.approx(df.agg(F.sum("w")).first()[0])


@pytest.mark.parametrize("block_rows", [50_000, 100])
def test_fits_by_key_are_those_of_each_key(spark, monkeypatch, block_rows):
    df = panel(spark, 900).withColumn("k", F.col("i") % 2 + 3)
    options = {"is_eval": F.col("i") % 5 == 0, "weight": "w", "rounds": 5, "depth": 3, "step": 0.3, "patience": 2}
    want = {k: B.fit_trees(df.where(F.col("k") == k), ["a", "b", "c"], "y", **options) for k in (3, 4)}
    monkeypatch.setattr(B, "BLOCK_ROWS", block_rows)
    got = B.fit_trees_by(df, "k", ["a", "b", "c"], "y", **options)
    assert set(got) == {3, 4}
    x = np.random.default_rng(5).normal(size=(200, 3))
    for k, model in want.items():
        assert got[k].losses == pytest.approx(model.losses)
        np.testing.assert_allclose(got[k].ensemble.score(x), model.ensemble.score(x), rtol=1e-9)


def test_small_fits_take_as_many_jobs_for_any_rounds_and_fits(spark):
    df = panel(spark, 300).withColumn("k", F.col("i") % 3)

    def jobs(fit, rounds):
        return jobs_of(spark, lambda: B.fit_trees_by(df.withColumn("one", F.lit(0)), fit, ["a", "b"], "y", rounds=rounds, depth=3))[1]

    few = jobs("one", 2)
    assert 0 < few < 15 and jobs("one", 12) == few and jobs("k", 12) == few


def test_large_fits_share_the_jobs_of_a_level(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    df = panel(spark, 300).withColumns({"k": F.col("i") % 3, "one": F.lit(0)})
    one, three = (jobs_of(spark, lambda: B.fit_trees_by(df, fit, ["a", "b"], "y", rounds=2, depth=2))[1] for fit in ("one", "k"))
    assert one == three


def test_unknown_values_count_as_the_largest(spark):
    df = panel(spark, 300).withColumns({"a": F.when(F.col("i") % 3 == 0, float("nan")).otherwise(F.col("a"))})
    df = df.withColumn("y", F.when(F.isnan("a"), -8.0).otherwise(F.col("y")))
    model = B.fit_trees(df, ["a", "b"], "y", rounds=5, depth=3)
    unknown = df.where(F.isnan("a"))
    got = [r.p for r in model.predict(unknown, "p").orderBy("i").collect()]
    assert got == [r.p for r in model.predict(unknown.withColumn("a", F.lit(1e9)), "p").orderBy("i").collect()] and np.mean(got) < -6


def test_rows_that_no_tree_can_fit_are_refused(spark):
    df = panel(spark, 50)
    for bad, held in ((df.withColumn("y", F.lit(float("nan"))), None), (df.withColumn("w", F.lit(-1.0)), None), (df, F.lit(True)), (df.limit(0), None)):
        with pytest.raises(ValueError):
            B.fit_trees(bad, ["a"], "y", is_eval=held, weight="w", rounds=2)


def test_summaries_keep_ranks(monkeypatch):
    rng = np.random.default_rng(2)
    value, weight = rng.normal(size=50_000), rng.uniform(0.1, 1, 50_000)
    few = np.floor(value * 10)
    distinct, total = B.summary(few, weight)
    assert list(distinct) == sorted(set(few)) and total.sum() == pytest.approx(weight.sum())
    halves = [B.summary(value[i::2], weight[i::2]) for i in range(2)]
    merged = B.summary(*(np.concatenate(p) for p in zip(*halves)))
    assert len(merged[0]) <= B.SUMMARY and merged[1].sum() == pytest.approx(weight.sum())
    cuts = B.cut_points(*merged)
    shares = [weight[value <= c].sum() / weight.sum() for c in cuts]
    np.testing.assert_allclose(shares, np.arange(1, B.BINS) / B.BINS, atol=0.002)
