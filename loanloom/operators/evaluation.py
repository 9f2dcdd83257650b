"""Exact classifier metrics from score counts.

Every metric starts by folding the rows to one line per distinct score, so ties
are handled as thresholds and a popular score costs one row after the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.columns import count_where
from loanloom.operators.ordered import range_bounds, running_totals

SCORE = "threshold"


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(F.col(score).alias(SCORE)).agg(
        count_where(F.col(label) == 1).alias("pos"),
        count_where(F.col(label) == 0).alias("neg"),
    )


def _swept(df: DataFrame, label: str, score: str) -> DataFrame:
    """Score counts with running counts from the highest score down."""
    return running_totals(score_counts(df, label, score), SCORE,
                          {"pos": "tp", "neg": "fp"}, descending=True,
                          totals={"pos": "all_pos", "neg": "all_neg"}, bounds=range_bounds(df, score))


def roc_auc(df: DataFrame, label: str = "defaulted", score: str = "risk_score") -> DataFrame:
    """Rank-sum area under the ROC curve; tied pairs count one half."""
    swept = _swept(df, label, score)
    # Negatives scored strictly lower, plus half of the tied ones.
    beaten = F.col("all_neg") - F.col("fp") + F.col("neg") * F.lit(0.5)
    pairs = F.sum(F.col("pos") * beaten)
    possible = F.max(F.col("all_pos").cast("double") * F.col("all_neg"))
    return swept.agg((pairs / F.nullif(possible, F.lit(0.0))).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "defaulted", score: str = "risk_score") -> DataFrame:
    """Precision at each threshold weighted by the recall it adds."""
    swept = _swept(df, label, score)
    gained = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return swept.agg((gained / F.nullif(F.max("all_pos"), F.lit(0))).alias("average_precision"))


def roc_curve(df: DataFrame, label: str = "defaulted", score: str = "risk_score") -> DataFrame:
    """One point per distinct threshold, plus the (0, 0) anchor with no threshold."""
    swept = _swept(df, label, score)
    points = swept.select(
        SCORE,
        (F.col("fp") / F.nullif("all_neg", F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif("all_pos", F.lit(0))).alias("tpr"),
    )
    return points.unionByName(_anchor(df, fpr=0.0, tpr=0.0))


def pr_curve(df: DataFrame, label: str = "defaulted", score: str = "risk_score") -> DataFrame:
    """One point per distinct threshold, plus the (recall 0, precision 1) anchor."""
    swept = _swept(df, label, score)
    points = swept.select(
        SCORE,
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.nullif("all_pos", F.lit(0))).alias("recall"),
    )
    return points.unionByName(_anchor(df, precision=1.0, recall=0.0))


def _anchor(df: DataFrame, **values: float) -> DataFrame:
    one = df.sparkSession.range(1)
    return one.select(F.lit(None).cast("double").alias(SCORE), *[F.lit(v).alias(k) for k, v in values.items()])


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Row counts for all four (label, prediction) pairs, empty ones included."""
    cells = df.agg(*[count_where((F.col(label) == y) & (F.col(predicted) == p)).alias(f"c{y}{p}")
                     for y in (0, 1) for p in (0, 1)])
    rows = F.array(*[F.struct(F.lit(y).alias("actual"), F.lit(p).alias("predicted"),
                              F.coalesce(F.col(f"c{y}{p}"), F.lit(0)).alias("n"))
                     for y in (0, 1) for p in (0, 1)])
    return cells.select(F.inline(rows))


def _f1(precision: Column, recall: Column) -> Column:
    return F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and averages."""
    y, p = F.col(label), F.col(predicted)
    counts = df.agg(
        count_where((y == 1) & (p == 1)).alias("tp"), count_where((y == 0) & (p == 1)).alias("fp"),
        count_where((y == 1) & (p == 0)).alias("fn"), count_where((y == 0) & (p == 0)).alias("tn"))

    def part(hit: str, miss: str) -> Column:
        whole = F.col(hit) + F.col(miss)
        return F.when(whole > 0, F.col(hit) / whole).otherwise(F.lit(0.0))

    rates = counts.select(
        "*",
        part("tn", "fn").alias("p0"), part("tn", "fp").alias("r0"), (F.col("tn") + F.col("fp")).alias("s0"),
        part("tp", "fp").alias("p1"), part("tp", "fn").alias("r1"), (F.col("tp") + F.col("fn")).alias("s1"),
    ).withColumns({"f0": _f1(F.col("p0"), F.col("r0")), "f1": _f1(F.col("p1"), F.col("r1"))})
    total = F.col("s0") + F.col("s1")

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1_score"), support.alias("support"))

    def mean(a: str) -> Column:
        return (F.col(a + "0") + F.col(a + "1")) / 2

    def weighted(a: str) -> Column:
        return (F.col(a + "0") * F.col("s0") + F.col(a + "1") * F.col("s1")) / F.nullif(total, F.lit(0))

    accuracy = (F.col("tp") + F.col("tn")) / F.nullif(total, F.lit(0))
    lines = F.array(
        line("No Default", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        line("Default", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        line("accuracy", accuracy, accuracy, accuracy, total),
        line("macro avg", mean("p"), mean("r"), mean("f"), total),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    )
    return rates.select(F.inline(lines))
