"""Properties of trained models and their explanations."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.hashing import seeded_uniform
from millrace.operators import evaluation, training, treeshap


@pytest.fixture(scope="module")
def data(spark):
    x = [seeded_uniform("id", f"t/{i}") for i in range(4)]
    rows = spark.range(400).select("id", F.array(*x).alias("features"))
    f = F.col("features")
    return rows.withColumn("y", ((f[0] > 0.5) & (f[1] > 0.3) | (f[2] > 0.8)).cast("int")).persist()


@pytest.fixture(scope="module")
def model(data):
    return training.fit(training.forest(6, 4), data)


def brute_shapley(tree_leaves, x):
    """Shapley values by the definition, over all coalitions."""
    d = len(x)

    def value(known):
        total = 0.0
        for leaf in tree_leaves:
            p = leaf["value"]
            for f, (lo, hi, share) in leaf["conditions"].items():
                p *= (1.0 if lo < x[f] <= hi else 0.0) if f in known else share
            total += p
        return total

    phi = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for size in range(d):
            weight = factorial(size) * factorial(d - size - 1) / factorial(d)
            for s in combinations(others, size):
                phi[i] += weight * (value({*s, i}) - value(set(s)))
    return phi


def leaves_of(tree, node=0, conditions=None):
    conditions = conditions or {}
    if tree.left[node] < 0:
        return [{"value": tree.value[node], "conditions": conditions}]
    f, cut = int(tree.feature[node]), tree.cut[node]
    low, high, share = conditions.get(f, (-np.inf, np.inf, 1.0))
    parts = ((tree.left[node], (low, min(high, cut))), (tree.right[node], (max(low, cut), high)))
    return [leaf for child, bounds in parts for leaf in leaves_of(tree, child, {**conditions, f: (*bounds, share * tree.share[child])})]


def test_forest_contributions_match_the_definition(spark, data, model):
    packed, base = treeshap.saved_trees(model.stages[-1], spark)
    trees = [leaves_of(t) for t in packed]
    assert sum(len(t.left) for t in packed) == sum(t.numNodes for t in model.stages[-1].trees)
    x = np.array([r.features for r in data.orderBy("id").limit(12).collect()])
    fast = treeshap.contributions(x, packed)
    slow = np.mean([[brute_shapley(t, row) for row in x] for t in trees], axis=0)
    assert np.allclose(fast, slow, atol=1e-12)
    p = [r.probabilities[1] for r in training.score(model, data).orderBy("id").limit(12).collect()]
    assert np.allclose(base + fast.sum(axis=1), p, atol=1e-9)


def test_a_feature_may_split_a_path_several_times(spark):
    """One feature decides in steps, so its factor is replaced down the path; weights count too."""
    rows = spark.range(300).select("id", F.array((F.col("id") / 300), seeded_uniform("id", "u")).alias("features"), ((F.col("id") / 60).cast("int") % 2).alias("y"))
    fitted = training.fit(training.forest(3, 6, weight="weight"), training.balanced(rows)).stages[-1]
    packed, base = treeshap.saved_trees(fitted, spark)
    x = np.array([[0.05, 0.4], [0.31, 0.9], [0.99, 0.1], [0.55, 0.55]])
    fast = treeshap.contributions(x, packed)
    slow = np.mean([[brute_shapley(leaves_of(t), row) for row in x] for t in packed], axis=0)
    assert np.allclose(fast, slow, atol=1e-12) and np.abs(fast).max() > 0.1


def test_large_forests_are_refused(spark, model, monkeypatch):
    monkeypatch.setattr(treeshap, "MAX_NODES", 10)
    with pytest.raises(ValueError, match="nodes"):
        treeshap.saved_trees(model.stages[-1], spark)


def test_forest_learns_and_importance_sums_to_one(spark, data, model):
    scored = training.score(model, data)
    assert evaluation.accuracy(scored).first().accuracy > 0.9
    table = training.importance_table(spark, model, list("abcd"))
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert training.top_importance(table, 2).count() == 2


def test_threshold_decides(data, model):
    strict = training.score(model, data, threshold=1.01)
    assert strict.where("pred = 1").count() == 0
    assert training.score(model, data, threshold=0.0).where("pred = 0").count() == 0


def test_last_stage_is_the_whole_forest(data, model):
    stages = {r.step: r for r in training.staged_metrics(model, data, [0, 1], epochs=3).collect()}
    assert [stages[i].trees for i in (1, 2, 3)] == [2, 4, 6]
    whole = evaluation.accuracy(training.score(model, data)).first().accuracy
    assert stages[3].accuracy == pytest.approx(whole)
    assert training.stage_sizes(10, 3) == [3, 6, 9] and training.stage_sizes(2, 5) == [1, 2, 2, 2, 2]


def test_linear_importance_and_probabilities(spark, data):
    model = training.fit(training.logistic(50), data)
    values = {r.feature: r.importance for r in training.importance_table(spark, model, list("abcd")).collect()}
    assert values["d"] == min(values.values())
    sums = training.score(model, data).select(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert sums.agg(F.max(F.abs(F.col("s") - 1))).first()[0] < 1e-9


def test_cross_validation_scores_every_fold(data):
    folds = training.cross_validate(data, training.forest(3, 3), k=3)
    assert folds.count() == 3
    row = training.fold_summary(folds).first()
    assert 0.5 < row.mean_accuracy <= 1 and row.folds == 3


def test_trials_differ_by_parameters(data):
    rows = training.run_trials(data, data, [{"n_estimators": 2, "max_depth": 1}, {"n_estimators": 4, "max_depth": 4}]).orderBy("trial").collect()
    assert [r.trial for r in rows] == [0, 1] and rows[1].accuracy > rows[0].accuracy


def test_boosting_and_balanced_weights(data):
    weighted = training.balanced(data)
    sums = {r.y: r.s for r in weighted.groupBy("y").agg(F.sum("weight").alias("s")).collect()}
    assert sums[0] == pytest.approx(sums[1])
    model = training.fit(training.boosted(5, 3), data)
    assert evaluation.accuracy(training.score(model, data)).first().accuracy > 0.9
    losses = [r.loss for r in training.boosted_curve(model, data).orderBy("step").collect()]
    assert len(losses) == 5 and losses[-1] < losses[0]
