import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import models, segments
from loanloom.plans.bank import Bank


@pytest.fixture(scope="module")
def bank(spark, sf):
    return Bank.of(spark, sf)


def test_split_is_stratified_and_stable(spark):
    df = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("customer_id"),
                                  (F.col("id") % 10 == 0).cast("int").alias("defaulted"))
    split = models.stratified_split(df)
    counts = {(r[0], r[1]): r[2] for r in split.groupBy("defaulted", "split").count().collect()}
    assert counts == {(0, "train"): 720, (0, "test"): 180, (1, "train"): 80, (1, "test"): 20}
    assert split.exceptAll(models.stratified_split(df.repartition(11))).count() == 0
    folds = models.stratified_folds(df).groupBy("defaulted", "fold").count().collect()
    assert {r["count"] for r in folds if r["defaulted"] == 0} == {180}
    assert {r["fold"] for r in folds} == set(range(5))


def test_logistic_model_learns_the_label(bank):
    data, inputs = bank.training()
    report, fitted = models.compare(data, inputs, [models.LOGISTIC])
    row = report.first()
    assert row["auc_roc"] > 0.88 and row["best"] and 0.8 < row["cv_auc_mean"] <= 1
    name, model = models.best_model(report, fitted)
    weights = dict(zip(inputs, model.stages[-1].coefficients.toArray()))
    assert weights["credit_score"] < 0 < weights["emi_to_income_ratio"]
    top = models.explain(name, model, data, inputs, k=5)
    assert top.first()["feature"] == "credit_score" and top.count() == 5
    ranked = models.feature_importance(model, inputs, bank.spark)
    assert ranked.count() == 20
    listed = models.importance_document(ranked, "importance").first()
    assert listed["features"] == [r["feature"] for r in ranked.collect()]
    assert listed["importance"] == sorted(listed["importance"], reverse=True)
    document = models.metrics_document(report).first()
    assert document["best_model"] == models.LOGISTIC == name
    assert document["models"][name]["auc_roc"] == document["best_auc"] == row["auc_roc"]


def test_best_model_is_the_first_of_the_unrounded_maximum(bank, monkeypatch):
    data, inputs = bank.training()
    figures = iter([{"auc_roc": x, "f1_score": 0.5, "avg_precision": 0.5} for x in (0.88004, 0.88001, 0.88004)])
    monkeypatch.setattr(models, "evaluate", lambda scored: next(figures))
    names = [models.BOOSTING, models.FOREST, models.LOGISTIC]
    report, _ = models.compare(data, inputs, names, cross_validated=False, fitted=lambda n: bank.trained(models.LOGISTIC))
    rows = report.collect()
    assert [r["best"] for r in rows] == [True, False, False] and {r["auc_roc"] for r in rows} == {0.88} and rows[1]["target_met"]


def test_linear_contributions(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    got = models.linear_shapley(df, {"a": F.col("a"), "b": F.col("b")}, {"a": -2.0, "b": 5.0}, {"a": 2.0, "b": 4.0})
    assert [tuple(r) for r in got.collect()] == [("a", 2.0), ("b", 0.0)]


def test_sampled_contributions_add_up(spark):
    """For a linear margin the sampled values follow the weights."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    rows = [(f"c{i}", int(3 * r[0] + r[1] > 0), *map(float, r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "customer_id string, defaulted int, a double, b double, c double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"),
                             LogisticRegression(labelCol="defaulted", regParam=0.05)]).fit(df)
    got = models.sampled_shapley(model, df.limit(60), ["a", "b", "c"], rounds=6).collect()
    every = models.shapley_values(model, df, ["a", "b", "c"], rounds=2).groupBy("customer_id").agg(
        F.count("*").alias("n"), F.abs(F.sum("phi") - F.max("gap")).alias("off"))
    assert every.count() == 400 and every.where("n <> 3 or off > 1e-9").count() == 0
    assert [r["feature"] for r in got] == ["a", "b", "c"]
    assert got[0]["mean_abs_shap"] > 2 * got[1]["mean_abs_shap"]


def test_models_without_a_probability_fall_back(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    df = spark.createDataFrame([(f"c{i}", i % 2, float(i % 2), float(i), "test") for i in range(40)],
                               "customer_id string, defaulted int, a double, b double, split string")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                             DecisionTreeRegressor(labelCol="defaulted")]).fit(df)
    got = models.explain("tree", model, df, ["a", "b"])
    assert got.columns == ["feature", "mean_abs_shap"] and got.first()["feature"] == "a"


def test_clusters_and_names(spark):
    rng = np.random.default_rng(1)
    centres = {"rich": (4.0, 0.0, 0.0), "risky": (0.0, 4.0, 0.0), "leaving": (0.0, 0.0, -6.0), "rest": (0.0, 0.0, 3.0)}
    rows = [(f"{name}{i}", *map(float, rng.normal(c, 0.2)))
            for name, c in centres.items() for i in range(40)]
    df = spark.createDataFrame(
        rows, "customer_id string, estimated_clv double, default_probability double, net_cash_flow_6m double")
    scaler = segments.fit_scaler(df)
    vectors = segments.standardised_vectors(df, scaler)
    model, cost = segments.fit_kmeans(vectors, 4, restarts=4)
    named = segments.assign_segments(model, vectors, scaler).collect()
    assert {(r["customer_id"].rstrip("0123456789"), r["segment"]) for r in named} == {
        ("rich", 0), ("risky", 1), ("rest", 2), ("leaving", 3)}
    sweep = segments.k_sweep(vectors, [2, 3, 4, 5], restarts=3).collect()
    assert [r["k"] for r in sweep if r["optimal"]] == [4]
    projected, shares = segments.pca_projection(vectors)
    assert projected.columns == ["customer_id", "pc1", "pc2"] and 0 < sum(shares) <= 1
    again, cost_again = segments.fit_kmeans(vectors, 4, restarts=4)
    assert cost == pytest.approx(cost_again)


def test_training_table_has_a_part_for_each_core(bank):
    data, _ = bank.training()
    assert data.rdd.getNumPartitions() == bank.spark.sparkContext.defaultParallelism


def test_steps_that_change_nothing_are_not_predicted(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    inputs = ["a", "b", "c", "same", "none"]
    df = spark.createDataFrame([(f"c{i}", i % 2, float(i % 2), float(i % 5), float(i % 3), 7.0, 0.0) for i in range(60)],
                               "customer_id string, defaulted int, a double, b double, c double, same double, none double")
    model = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"),
                             LogisticRegression(labelCol="defaulted", regParam=0.05)]).fit(df)
    predicted = []
    plain = models._predicted
    monkeypatch.setattr(models, "_predicted", lambda m, rows, i: predicted.append(rows) or plain(m, rows, i))
    values = models.shapley_values(model, df, inputs, rounds=2).collect()
    assert len(values) == 60 * 5 and all(r["phi"] == 0 for r in values if r["feature"] in ("same", "none"))
    assert predicted[0].count() <= 60 * 2 * 4
    # A model without an assembler of its inputs gets them as columns.
    other = Pipeline(stages=[VectorAssembler(inputCols=inputs[::-1], outputCol="features"),
                             LogisticRegression(labelCol="defaulted", regParam=0.05)]).fit(df)
    got = {(r["customer_id"], r["feature"]): r["phi"] for r in models.shapley_values(other, df, inputs, rounds=2).collect()}
    assert all(abs(got[r["customer_id"], r["feature"]] - r["phi"]) < 1e-4 for r in values)


def test_folds_of_all_models_are_fitted_side_by_side(bank, monkeypatch):
    import threading
    data, inputs = bank.training()
    names = [models.LOGISTIC, models.FOREST]
    together = threading.Barrier(len(names) * models.FOLDS)
    monkeypatch.setattr(models, "fold_auc", lambda pipeline, train, fold: (together.wait(60), 0.8 + fold / 100)[1], raising=False)
    monkeypatch.setattr(models, "evaluate", lambda scored: {"auc_roc": 0.9, "f1_score": 0.5, "avg_precision": 0.5})
    report, _ = models.compare(data, inputs, names, fitted=lambda n: bank.trained(models.LOGISTIC))
    assert [r["cv_auc_mean"] for r in report.collect()] == [0.82, 0.82]
