import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanloom.operators import evaluation, scoring


def sample(n, distinct, seed):
    rng = random.Random(seed)
    return [(int(rng.random() < 0.2 + 0.6 * s), s) for s in (rng.randrange(distinct) / distinct for _ in range(n))]


def pairwise_auc(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def step_ap(rows):
    total, recall, area = sum(y for y, _ in rows), 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        picked = [y for y, s in rows if s >= t]
        area += (sum(picked) / total - recall) * sum(picked) / len(picked)
        recall = sum(picked) / total
    return area


@pytest.mark.parametrize("n, distinct", [(300, 7), (400, 10_000)])
def test_ranking_metrics(spark, n, distinct):
    rows = sample(n, distinct, n)
    df = spark.createDataFrame(rows, "y int, s double").repartition(5)
    assert evaluation.roc_auc(df, "y", "s").first()[0] == pytest.approx(pairwise_auc(rows), abs=1e-12)
    assert evaluation.average_precision(df, "y", "s").first()[0] == pytest.approx(step_ap(rows), abs=1e-12)


def test_auc_agrees_with_the_evaluator(spark):
    rows = [(y, s + i * 1e-9) for i, (y, s) in enumerate(sample(300, 1000, 9))]
    df = spark.createDataFrame(rows, "label int, s double")
    library = BinaryClassificationEvaluator(rawPredictionCol="s", numBins=0).evaluate(df)
    assert evaluation.roc_auc(df, "label", "s").first()[0] == pytest.approx(library, abs=1e-9)


def test_constant_score(spark):
    df = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.3)], "y int, s double")
    assert evaluation.roc_auc(df, "y", "s").first()[0] == 0.5


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y int, s double")
    assert evaluation.roc_auc(df, "y", "s").first()[0] is None


def test_curves(spark):
    rows = sample(200, 20, 4)
    df = spark.createDataFrame(rows, "y int, s double")
    pos = sum(y for y, _ in rows)
    for r in evaluation.roc_curve(df, "y", "s").collect():
        picked = [y for y, s in rows if r["threshold"] is not None and s >= r["threshold"]]
        assert (r["tpr"], r["fpr"]) == pytest.approx(
            (sum(picked) / pos, (len(picked) - sum(picked)) / (len(rows) - pos)))
    points = evaluation.pr_curve(df, "y", "s").collect()
    assert len(points) == len({s for _, s in rows}) + 1
    assert (None, 1.0, 0.0) in [tuple(p) for p in points]


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4, "y int, p int")
    assert {(r[0], r[1]): r[2] for r in evaluation.confusion(df, "y", "p").collect()} == {
        (1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 4}
    report = {r["class"]: r for r in evaluation.classification_report(df, "y", "p").collect()}
    assert report["Default"]["precision"] == pytest.approx(0.6)
    assert report["Default"]["recall"] == pytest.approx(0.75)
    assert report["accuracy"]["f1_score"] == pytest.approx(0.7)
    assert report["weighted avg"]["recall"] == pytest.approx(0.7)
    assert report["macro avg"]["support"] == 10


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(0, 0)] * 3, "y int, p int")
    report = {r["class"]: r for r in evaluation.classification_report(df, "y", "p").collect()}
    assert (report["Default"]["precision"], report["Default"]["recall"], report["Default"]["f1_score"]) == (0, 0, 0)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "defaulted int")
    assert {r[0]: r[2] for r in scoring.class_weights(df).collect()} == pytest.approx({0: 8 / 12, 1: 2.0})


def test_labels_do_not_depend_on_partitioning(spark):
    df = spark.range(500).select(F.concat(F.lit("C"), "id").alias("customer_id"), F.rand(3).alias("risk_score"))
    df = spark.createDataFrame(df.collect(), df.schema)
    cuts = scoring.fit_label_cuts(df)

    def label(frame):
        return frame.select("customer_id", scoring.default_label(F.col("risk_score"), cuts).alias("y"))

    once, again = label(df), label(df.repartition(13))
    assert once.exceptAll(again).count() == 0
    assert set(r["y"] for r in once.collect()) == {0, 1}


def test_scorer_fits_and_labels(spark):
    rows = [(f"c{i}", 1000.0 * i, 300 + 6 * i, 0, 0.0, 0, 0.0, 0.0, "Retired") for i in range(101)]
    df = spark.createDataFrame(rows, "customer_id string, income double, credit_score long, has_loan long, "
                                     "loan_amount double, loan_tenure_months long, credit_limit double, "
                                     "cc_balance double, employment_type string")
    scale = scoring.fit_risk_scale(df)
    cuts = scoring.fit_label_cuts(df.withColumn("risk_score", scoring.risk_score(scale)))
    out = {r["customer_id"]: r for r in scoring.with_label(df, scale, cuts).collect()}
    assert out["c100"]["risk_score"] == 0.0 and out["c0"]["risk_score"] == pytest.approx(1.0)
    assert out["c0"]["defaulted"] == 1 and out["c100"]["defaulted"] == 0
    assert 45 <= sum(r["defaulted"] for r in out.values()) <= 56


def test_scenarios(spark):
    book = spark.createDataFrame(
        [("a", 1000.0, 600, 0.0, 0.5, 100.0, 12.0, 24, 12, "Retired", 0.2, 50.0)],
        "customer_id string, income double, credit_score long, loan_amount double, credit_utilisation_ratio double, "
        "credit_limit double, interest_rate_pct double, tenure_months long, loan_tenure_months long, "
        "employment_type string, default_probability double, estimated_clv double")
    cases = {"same": {}, "loan": {"loan_amount": "1200D"}}
    got = {r["scenario"]: r for r in scoring.what_if_rules(book, cases, scoring.RiskScale(0.0, 1.0)).collect()}
    assert got["same"]["annual_revenue_est"] == pytest.approx(1000 * 0.003 + 100 * 0.02)
    assert got["loan"]["annual_revenue_est"] == pytest.approx(5 + 1200 * 0.12)
    assert got["loan"]["simulated_probability"] > got["same"]["simulated_probability"]
    assert got["same"]["probability_change"] == pytest.approx(got["same"]["simulated_probability"] - 0.2)
    with pytest.raises(ValueError):
        scoring.expand_scenarios(book, {"x": {"age": "1"}})


def test_nan_counts_as_missing(spark):
    from loanloom.operators import distributions
    from loanloom.operators.ordered import quantile_values
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (float("nan"), "a"), (None, "a")], "x double, g string")
    bins = distributions.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [1, 0, 0, 1] and [r["midpoint"] for r in bins] == [1.125, 1.375, 1.625, 1.875]
    assert quantile_values(df, "x", [0.5]) == [1.5]
    box = distributions.box_stats(df, "g", "x").first()
    assert (box["n"], box["min"], box["max"]) == (2, 1.0, 2.0)
