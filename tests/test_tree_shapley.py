import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loanloom.operators import models, tree_shapley


def random_tree(draw, features, depth, cover=1000.0):
    nodes = {}

    def grow(cover, level):
        at = len(nodes)
        nodes[at] = None
        if level == depth or cover < 2 or draw.random() < 0.15:
            nodes[at] = (-1, -1, -1, 0.0, cover, float(draw.normal()))
            return at
        left = float(int(cover * draw.uniform(0.05, 0.95)))
        feature, threshold = int(draw.integers(features)), float(draw.normal())
        one, two = grow(left, level + 1), grow(cover - left, level + 1)
        nodes[at] = (one, two, feature, threshold, cover, 0.0)
        return at

    grow(cover, 0)
    return nodes


def known_value(nodes, x, known, at=0):
    left, right, feature, threshold, cover, value = nodes[at]
    if left < 0:
        return value
    if feature in known:
        return known_value(nodes, x, known, left if x[feature] <= threshold else right)
    return sum(nodes[c][4] / cover * known_value(nodes, x, known, c) for c in (left, right) if cover)


def enumerated(trees, x):
    d = len(x)
    value = {s: sum(known_value(t, x, s) for t in trees) for r in range(d + 1) for s in map(frozenset, itertools.combinations(range(d), r))}
    phi = [sum(math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d) * (value[s | {i}] - value[s])
               for s in value if i not in s) for i in range(d)]
    return phi, value[frozenset()], value[frozenset(range(d))]


@pytest.mark.parametrize("features, depth", [(1, 3), (3, 2), (4, 6), (6, 8)])
def test_equals_enumeration_of_all_subsets(features, depth):
    draw = np.random.default_rng(features * 10 + depth)
    trees = [random_tree(draw, features, depth) for _ in range(3)]
    groups, base = tree_shapley.grouped([p for t in trees for p in tree_shapley.leaf_paths(t)])
    rows = draw.normal(size=(12, features))
    rows[0, 0] = trees[0][0][3]      # a value on a threshold goes left
    got = tree_shapley.contributions(rows, groups)
    for x, phi in zip(rows, got):
        expected, none, whole = enumerated(trees, x)
        assert phi == pytest.approx(expected, abs=1e-12) and base == pytest.approx(none) and base + phi.sum() == pytest.approx(whole)


def test_branches_that_no_row_took():
    nodes = {0: (1, 2, 0, 0.0, 10.0, 0.0), 1: (3, 4, 1, 0.0, 0.0, 0.0), 2: (-1, -1, -1, 0.0, 10.0, 1.0),
             3: (-1, -1, -1, 0.0, 0.0, 5.0), 4: (-1, -1, -1, 0.0, 0.0, 7.0)}
    groups, base = tree_shapley.grouped(tree_shapley.leaf_paths(nodes))
    for x in ([-1.0, -1.0], [-1.0, 1.0], [1.0, 0.0]):
        phi = tree_shapley.contributions(np.array([x]), groups)[0]
        assert phi == pytest.approx(enumerated([nodes], x)[0]) and base == 1.0


def test_fitted_models_explain_their_own_predictions(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 4))
    rows = [(f"c{i}", *map(float, r), int(r[0] + r[1] * r[2] > 0), 1.0 + (i % 3)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "customer_id string, a double, b double, c double, d double, defaulted int, class_weight double")
    df = df.withColumn("d", F.when(F.col("customer_id") != "c7", F.col("d")))
    inputs = ["a", "b", "c", "d"]
    filled = df.fillna(0.0)
    assemble = VectorAssembler(inputCols=inputs, outputCol="features")
    for estimator in (RandomForestClassifier(numTrees=12, maxDepth=5, labelCol="defaulted", weightCol="class_weight", seed=1),
                      GBTClassifier(maxIter=8, maxDepth=3, labelCol="defaulted", seed=1)):
        model = Pipeline(stages=[assemble, estimator]).fit(filled)
        paths = tree_shapley.model_paths(model, spark)
        values = tree_shapley.tree_contributions(paths, df, inputs)
        p = models.score(model, filled).select("customer_id", "p_default")
        met = values.join(p, "customer_id").collect()
        assert len(met) == 400
        for r in met:
            told = r["p_default"] if isinstance(estimator, RandomForestClassifier) else math.log(r["p_default"] / (1 - r["p_default"]))
            assert r["explained"] == pytest.approx(told, abs=1e-9)
        ranked = tree_shapley.mean_contributions(values, inputs).collect()
        assert {r["feature"] for r in ranked[:3]} == {"a", "b", "c"} and len(ranked) == 4
        assert ranked[0]["mean_abs_shap"] == pytest.approx(max(np.abs([r["phi"] for r in met]).mean(axis=0)), abs=1e-6)
    with pytest.raises(TypeError):
        tree_shapley.model_paths(Pipeline(stages=[assemble]).fit(filled), spark)


def test_cases_of_a_leaf_are_worked_out_once(monkeypatch):
    draw = np.random.default_rng(5)
    groups, _ = tree_shapley.grouped([p for _ in range(3) for p in tree_shapley.leaf_paths(random_tree(draw, 6, 7))])
    x = draw.normal(size=(9000, 6))
    x[::7, 2] = np.nan
    told = np.concatenate([tree_shapley.contributions(x[i:i + 1], groups) for i in range(0, 9000, 300)])
    worked = []
    parts = tree_shapley._parts
    monkeypatch.setattr(tree_shapley, "_parts", lambda inside, g: worked.append(inside.shape[0] * inside.shape[1]) or parts(inside, g))
    assert np.allclose(tree_shapley.contributions(x, groups)[::300], told, atol=1e-12)
    assert sum(worked) <= sum(len(g.value) << g.feature.shape[1] for g in groups)
