"""The full batch run: three base tables in, every output table out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators import arma, audit, clv, features, forecast, models, scoring, segments, trend
from loanloom.sources import tables

#: Forecast methods by name: exact likelihood, its two-stage approximation, trend with changes, trend times month of year.
FORECASTS = {"arima": arma.arima_exact, "arima_two_stage": forecast.arima_forecast, "trend": trend.trend_forecast,
             "seasonal": forecast.seasonal_forecast}

BASE_TABLES = ("customers", "repayment_history", "transactions")


class Outputs:
    """Where a run writes; every table is read back from there by the later stages."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.written: dict[str, DataFrame] = {}

    def save(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        tables.write_table(df, path)
        self.written[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.written[name]

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"


def run(spark: SparkSession, source: str, target: str, fmt: str = "parquet",
        model_names: Sequence[str] = (models.LOGISTIC, models.FOREST, models.BOOSTING),
        cross_validated: bool = True, forecast_method: str = "arima", clusters: int = 4,
        restarts: int = 20, levels_from: str | None = None) -> DataFrame:
    """Build features, train and score, estimate value, forecast, segment; return the audit.

    ``source`` holds one folder (or file) per base table, ``target`` receives the outputs.
    The levels of the categorical columns are stored beside the models; ``levels_from`` names the folder of an
    earlier run whose levels (and so whose model columns) are used again.
    Tables are written at the boundaries where a later stage reads them many times.
    """
    customers, repayments, transactions = (
        tables.read_table(spark, f"{source}/{name}", name, fmt) for name in BASE_TABLES)
    out = Outputs(spark, target)

    levels = tables.read_levels(spark, f"{levels_from.rstrip('/')}/levels") if levels_from else features.fit_levels(customers)
    tables.write_levels(spark, levels, out.path("levels"))
    matrix = out.save("feature_matrix", features.feature_matrix(customers, repayments, transactions, levels))

    data, inputs = models.training_set(matrix)
    report, fitted = models.compare(data, inputs, model_names, cross_validated)
    name, model = models.best_model(report, fitted)
    tables.write_metrics(models.metrics_document(report), out.path("model_metrics"))
    for label, each in fitted.items():
        tables.save_model(each, out.path("models/" + label.replace(" ", "_")))
    ranked = models.feature_importance(model, inputs, spark)
    tables.write_metrics(models.importance_document(ranked, "importance"), out.path("feature_importance"))
    shares = models.importance_document(models.explain(name, model, data, inputs), "mean_abs_shap")
    tables.write_metrics(shares.withColumn("model", F.lit(name)), out.path("shap_feature_importance"))
    tables.write_metrics(audit.auc_target(report), out.path("auc_target"))

    # Scores cover the whole book, the training rows too.
    scored = models.score(model, models.prepare(matrix, inputs)[0])
    risk = out.save("risk_scored", scoring.assign_risk_tiers(scored, "p_default"))

    monthly = out.save("monthly_revenue", forecast.monthly_revenue(transactions))
    ahead = FORECASTS[forecast_method](monthly)
    out.save("revenue_forecast", forecast.with_history(monthly, ahead))

    values = out.save("clv_values", clv.estimate_clv(customers, risk))
    estimates = out.save("clv_estimates", clv.with_clv_tier(values, clv.fit_clv_cuts(values)))

    cluster_inputs = out.save("cluster_inputs", segments.cluster_inputs(matrix, estimates, risk))
    scaler = segments.fit_scaler(cluster_inputs)
    vectors = segments.standardised_vectors(cluster_inputs, scaler)
    kmeans, _ = segments.fit_kmeans(vectors, clusters, restarts)
    assigned = out.save("customer_segments", segments.assign_segments(kmeans, vectors, scaler))
    out.save("segment_profile", segments.profile_segments(cluster_inputs.join(assigned, "customer_id")))

    checked = {"customers": customers, "repayment_history": repayments, "transactions": transactions,
               **{n: out.written[n] for n in ("feature_matrix", "risk_scored", "clv_estimates",
                                              "customer_segments", "monthly_revenue", "revenue_forecast")}}
    return audit.integrity_audit(checked)
