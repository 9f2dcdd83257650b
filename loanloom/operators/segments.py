"""Customer segmentation: standardising, clustering, profiling."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.operators.kmeans import Centres, best_of, fit_many, plain_silhouette, plain_silhouettes
from loanloom.operators.ordered import exact_quantiles
from loanloom.session import materialise

# The clustering inputs.
CLUSTER_FEATURES = [
    "credit_score", "income", "credit_utilisation_ratio", "repayment_consistency_score",
    "total_missed_payments", "spending_volatility", "avg_monthly_spend", "net_cash_flow_6m",
    "income_to_loan_ratio", "estimated_clv", "default_probability",
]
RADAR_REPORT = ["credit_score", "income", "repayment_consistency_score", "spending_volatility",
                "default_probability"]
RADAR_DASH = ["credit_score", "repayment_consistency_score", "spending_volatility",
              "default_probability", "credit_utilisation_ratio"]


class Scaler(NamedTuple):
    """Mean and population deviation per feature."""

    columns: list[str]
    means: list[float]
    deviations: list[float]


def cluster_inputs(features: DataFrame, clv: DataFrame | None, risk: DataFrame | None) -> DataFrame:
    """Features joined with the value and risk outputs that exist (one row per customer each)."""
    out = features
    if clv is not None:
        out = out.join(clv.select("customer_id", "estimated_clv"), "customer_id", "left")
    if risk is not None:
        out = out.join(risk.select("customer_id", "default_probability"), "customer_id", "left")
    return out


def fit_scaler(df: DataFrame, columns: Sequence[str] = tuple(CLUSTER_FEATURES)) -> Scaler:
    """Statistics of the columns that exist, NULL counted as zero, in one pass."""
    present = [c for c in columns if c in df.columns]
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in present}
    row = df.agg(*[F.avg(x).alias(f"m_{c}") for c, x in filled.items()],
                 *[F.stddev_pop(x).alias(f"s_{c}") for c, x in filled.items()]).first()
    return Scaler(present, [row[f"m_{c}"] for c in present], [row[f"s_{c}"] for c in present])


def z_columns(scaler: Scaler) -> dict[str, Column]:
    """Standardised columns; a constant feature becomes 0."""
    out = {}
    for name, mean, deviation in zip(scaler.columns, scaler.means, scaler.deviations):
        value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        out[name] = (value - F.lit(mean)) / F.lit(deviation) if deviation > 0 else F.lit(0.0)
    return out


def zscore(df: DataFrame, scaler: Scaler, keep: Sequence[str] = ("customer_id",)) -> DataFrame:
    return df.select(*keep, *[x.alias(f"z_{c}") for c, x in z_columns(scaler).items()])


def nearest_centroid_column(scaler: Scaler, centroids: dict[int, list[float]]) -> Column:
    """Segment of the closest centroid in standardised space; ties go to the lowest id.

    The centroids are literals of the expression: no join and no shuffle.
    """
    z = list(z_columns(scaler).values())
    options = []
    for segment, center in sorted(centroids.items()):
        squares = [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(z, center)]
        options.append(F.struct(sum(squares[1:], squares[0]).alias("distance"), F.lit(segment).alias("segment")))
    return F.array_min(F.array(*options))["segment"]


def nearest_centroid(df: DataFrame, scaler: Scaler, centroids: dict[int, list[float]]) -> DataFrame:
    return df.select("customer_id", nearest_centroid_column(scaler, centroids).alias("segment"))


def standardised_vectors(df: DataFrame, scaler: Scaler, keep: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Standardised inputs as a vector column, written once for the many passes of a fit."""
    names = [f"z_{c}" for c in scaler.columns]
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(zscore(df, scaler, keep))
    return materialise(assembled.select(*keep, "features"))


def fit_kmeans(vectors: DataFrame, k: int = 4, restarts: int = 20, seed: int = 42) -> tuple[Centres, float]:
    """Best of several seeded fits by within-cluster cost; all of them share every scan."""
    best = best_of(fit_many(vectors, [(k, seed + i) for i in range(restarts)]))
    return best, best.cost


def silhouette(model: Centres, vectors: DataFrame) -> float:
    """Squared-Euclidean silhouette over all rows (one aggregation per cluster, no sampling)."""
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(model.transform(vectors))


def k_sweep(vectors: DataFrame, ks: Sequence[int] = tuple(range(2, 10)), restarts: int = 10,
            seed: int = 42, sample: int | None = None) -> DataFrame:
    """Inertia and plain-distance silhouette per cluster count; the best silhouette is marked.

    All fits of all counts share every scan, and all silhouettes the distances of every row to every other.  ``sample`` as in
    :func:`plain_silhouette`.
    """
    fits = fit_many(vectors, [(k, seed + i) for k in ks for i in range(restarts)])
    best = [best_of(fits[n * restarts:(n + 1) * restarts]) for n in range(len(ks))]
    if sample is None:
        labelled = vectors.select("features")
        for k, model in zip(ks, best):
            labelled = model.transform(labelled).withColumnRenamed("prediction", f"in{k}")
        labels = F.array(*[F.col(f"in{k}").cast("int") for k in ks]).alias("labels")
        values = plain_silhouettes(labelled.select(vector_to_array("features").alias("x"), labels), ks)
    else:
        values = [plain_silhouette(model.transform(vectors), k, sample) for k, model in zip(ks, best)]
    rows = [(k, float(model.cost), value) for k, model, value in zip(ks, best, values)]
    chosen = max(rows, key=lambda r: r[2] if r[2] is not None else -2.0)[0]
    return vectors.sparkSession.createDataFrame(
        [(*r, r[0] == chosen) for r in rows], "k int, inertia double, silhouette double, optimal boolean")


def canonical_ids(model: Centres, scaler: Scaler) -> dict[int, int]:
    """Map arbitrary cluster ids to named segments by where the centres lie.

    The riskiest centre is Vulnerable (1); of the rest the most valuable is Premium (0), then the
    one with the weakest cash flow is Churner (3), the others Growth (2) and on.
    """
    centers = [dict(zip(scaler.columns, map(float, c))) for c in model.clusterCenters()]
    left = list(range(len(centers)))
    mapping = {}

    def take(feature: str, target: int, lowest: bool = False) -> None:
        if left:
            chosen = sorted(left, key=lambda i: (centers[i].get(feature, 0.0) * (1 if lowest else -1), i))[0]
            mapping[chosen] = target
            left.remove(chosen)

    take("default_probability", 1)
    take("estimated_clv", 0)
    take("net_cash_flow_6m", 3, lowest=True)
    take("credit_score", 2)
    for extra, cluster in enumerate(left):
        mapping[cluster] = 4 + extra
    return mapping


def assign_segments(model: Centres, vectors: DataFrame, scaler: Scaler) -> DataFrame:
    ids = canonical_ids(model, scaler)
    lookup = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    return model.transform(vectors).select("customer_id", lookup[F.col("prediction")].alias("segment"))


def pca_projection(vectors: DataFrame, k: int = 2) -> tuple[DataFrame, list[float]]:
    """First components of the standardised vectors (already centred) and their variance shares."""
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(vectors)
    parts = vector_to_array("pca")
    kept = [c for c in vectors.columns if c != "features"]
    projected = model.transform(vectors).select(*kept, *[parts[i].alias(f"pc{i + 1}") for i in range(k)])
    return projected, [float(v) for v in model.explainedVariance]


# -- profiles -----------------------------------------------------------------

def profile_segments(df: DataFrame, features: Sequence[str] = tuple(CLUSTER_FEATURES)) -> DataFrame:
    """Mean, median and count of each feature and of the label, per segment.

    The exact medians of all features are found together, over (segment, feature)
    groups whose values are first folded to counts.
    """
    columns = [c for c in [*features, "defaulted"] if c in df.columns]
    plain = df.groupBy("segment").agg(*[a for c in columns for a in (
        F.avg(c).alias(f"{c}_mean"), F.count(c).alias(f"{c}_count"))])
    long = df.select("segment", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        "segment", columns, "feature", "value")
    medians = (exact_quantiles(long, "value", {"median": 0.5}, by=["segment", "feature"])
               .groupBy("segment").pivot("feature", columns).agg(F.first("median")))
    renamed = medians.select("segment", *[F.col(c).alias(f"{c}_median") for c in columns])
    order = [f"{c}_{stat}" for c in columns for stat in ("mean", "median", "count")]
    return plain.join(renamed, "segment").select("segment", *order)


def segment_headline(df: DataFrame) -> DataFrame:
    """Size and the main means per segment."""
    means = {"credit_score": "avg_credit_score", "income": "avg_income", "defaulted": "default_rate",
             "estimated_clv": "avg_clv", "default_probability": "avg_default_prob"}
    return (df.groupBy("segment").agg(F.count(F.lit(1)).alias("n"),
                                      *[F.avg(c).alias(a) for c, a in means.items() if c in df.columns])
              .orderBy("segment"))


def segment_radar(df: DataFrame, features: Sequence[str] = tuple(RADAR_REPORT)) -> DataFrame:
    """Per-segment means rescaled across segments.  The window sees one row per segment."""
    present = [c for c in features if c in df.columns]
    means = df.groupBy("segment").agg(*[F.avg(c).alias(c) for c in present])
    everywhere = Window.partitionBy()

    def rescaled(c: str) -> Column:
        low, high = F.min(c).over(everywhere), F.max(c).over(everywhere)
        return (F.col(c) - low) / (high - low + F.lit(1e-9))

    return means.select("segment", *[rescaled(c).alias(c) for c in present]).orderBy("segment")
