"""All registered queries over the driver tables.

Every entry takes ``(spark, sf_dir)``, reads the whole tables and returns a lazy
DataFrame.  Floating results are rounded here, so that engines that add in
another order agree.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom import schemas
from loanloom.functions.columns import half_up
from loanloom.operators import (arma, audit, book, distributions, evaluation, features, forecast, models,
                                portfolio, repayment_state, scoring, segments, stationarity, tree_shapley, trend)
from loanloom.plans.bank import TIE_BREAK, Bank
from loanloom.session import ensure_checkpoint_dir
from loanloom.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Whole-book scenarios of the what-if queries.
SCENARIOS = {
    "unchanged": {},
    "income_down_20": {"income": "income * 0.8D"},
    "loan_up_50": {"loan_amount": "loan_amount * 1.5D"},
    "score_down_100": {"credit_score": "greatest(credit_score - 100, 300)"},
    "card_maxed": {"credit_utilisation_ratio": "1.0D"},
}
# The rule trees of the rule_tree_shap query: node -> (left, right, input, threshold, value); left -1 marks a leaf.
RULE_INPUTS = ["credit_score", "income", "age"]
RULE_TREES = [
    {0: (1, 2, 0, 600, 0), 1: (3, 4, 1, 500_000, 0), 2: (5, 6, 0, 750, 0), 3: (-1, -1, 0, 0, 0.6), 4: (-1, -1, 0, 0, 0.4),
     5: (-1, -1, 0, 0, 0.25), 6: (7, 8, 1, 1_000_000, 0), 7: (-1, -1, 0, 0, 0.2), 8: (-1, -1, 0, 0, 0.05)},
    {0: (1, 2, 2, 40, 0), 1: (3, 4, 0, 550, 0), 2: (5, 6, 1, 250_000, 0), 3: (-1, -1, 0, 0, 0.3), 4: (-1, -1, 0, 0, 0.1),
     5: (-1, -1, 0, 0, 0.12), 6: (7, 8, 2, 55, 0), 7: (-1, -1, 0, 0, 0.02), 8: (9, 10, 0, 700, 0), 9: (-1, -1, 0, 0, 0.08),
     10: (-1, -1, 0, 0, 0.01)},
]

# Weights of the linear model whose contributions the linear_shap query reports.
SHAP_WEIGHTS = {
    "credit_score": -0.9, "income": -0.4, "credit_utilisation_ratio": 0.35,
    "repayment_consistency_score": -0.5, "total_missed_payments": 0.45, "spending_volatility": 0.1,
    "avg_monthly_spend": 0.05, "net_cash_flow_6m": -0.15, "income_to_loan_ratio": -0.2,
    "estimated_clv": -0.1, "default_probability": 1.2,
}
# Sums of cents keep two digits; means and ratios more, to stay clear of rounding ties.
SPEND_DIGITS = {"spending_volatility": 4, "avg_monthly_spend": 6, "total_debit_6m": 2, "total_credit_6m": 2,
                "net_cash_flow_6m": 2, "transaction_frequency": 6}


def query(build: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
    """Register a function of the bank under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Bank.of(spark, sf_dir))
    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int | dict[str, int] = 6, default: int | None = None) -> DataFrame:
    """Round floating columns: all of them to ``digits``, or each to its own."""
    own = digits if isinstance(digits, dict) else {}
    fallback = digits if isinstance(digits, int) else default
    columns = []
    for field in df.schema:
        places = own.get(field.name, fallback)
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType) and places is not None:
            column = half_up(column, places)
        columns.append(column.alias(field.name))
    return df.select(*columns)


# -- portfolio reports --------------------------------------------------------

@query
def q1_default_by_employment(b: Bank):
    return portfolio.default_by_employment(b.customers())


@query
def q1_default_by_employment_dash(b: Bank):
    return rounded(portfolio.default_by_employment_dash(b.customers()), 4)


@query
def q2_high_risk_customers(b: Bank):
    return rounded(portfolio.high_risk_customers(b.customers(), b.risk(), b.segments()), 4)


@query
def q2_high_risk_customers_dash(b: Bank):
    return rounded(portfolio.high_risk_customers_dash(b.book()), 4)


@query
def q3_emi_collection(b: Bank):
    return rounded(portfolio.emi_collection(b.repayments()), 2)


@query
def q3_emi_collection_dash(b: Bank):
    return rounded(portfolio.emi_collection_dash(b.repayments()), 2)


@query
def q4_utilisation_bands(b: Bank):
    return portfolio.utilisation_bands(b.customers())


@query
def q4_utilisation_bands_dash(b: Bank):
    return rounded(portfolio.utilisation_bands_dash(b.customers()), 4)


@query
def q5_city_npa(b: Bank):
    return rounded(portfolio.city_npa(b.customers()), 2)


@query
def q5_city_npa_dash(b: Bank):
    return rounded(portfolio.city_npa_dash(b.customers()), 2)


@query
def q6_category_spend(b: Bank):
    return portfolio.category_spend(b.transactions("amount", "transaction_type", "category"))


@query
def q6_category_spend_dash(b: Bank):
    return rounded(portfolio.category_spend_dash(b.transactions("amount", "transaction_type", "category")), 2)


@query
def q7_clv_distribution(b: Bank):
    return portfolio.clv_distribution(b.clv())


@query
def q7_clv_distribution_dash(b: Bank):
    return rounded(portfolio.clv_distribution_dash(b.book()), 2)


@query
def q8_rolling_defaults(b: Bank):
    return portfolio.rolling_defaults(b.repayments())


@query
def q9_tenure_cohorts(b: Bank):
    return portfolio.tenure_cohorts(b.customers(), b.repayments())


@query
def q9_tenure_cohorts_dash(b: Bank):
    return rounded(portfolio.tenure_cohorts_dash(b.customers(), b.repayments()), 4)


@query
def q10_cross_sell_targets(b: Bank):
    return portfolio.cross_sell_targets(b.customers(), b.clv(), b.risk())


@query
def q10_cross_sell_targets_dash(b: Bank):
    return portfolio.cross_sell_targets_dash(b.book())


@query
def q11_income_bands(b: Bank):
    return portfolio.income_bands(b.customers())


@query
def q11_income_bands_dash(b: Bank):
    return rounded(portfolio.income_bands_dash(b.customers()), {"npa_exposure": 2}, 4)


@query
def q12_churner_clv_by_city(b: Bank):
    return portfolio.churner_clv_by_city(b.customers(), b.risk(), b.clv(), b.segments())


@query
def q12_churner_clv_by_city_dash(b: Bank):
    return rounded(portfolio.churner_clv_by_city_dash(b.segmented_book()), 2)


# -- features -------------------------------------------------------------------

@query
def repayment_features(b: Bank):
    return rounded(features.repayment_features(b.repayments(), TIE_BREAK), 8)


@query
def repayment_features_grown(b: Bank):
    """The same features from states of three stretches of time, merged one after the other."""
    rows = b.repayments()
    cuts = [F.col("due_date") < "1997-01-01", F.col("due_date").between("1997-01-01", "1998-12-31"), F.col("due_date") > "1998-12-31"]
    states = [repayment_state.state_of(rows.where(c), TIE_BREAK) for c in cuts]
    return rounded(repayment_state.features_of(functools.reduce(repayment_state.grown, states)), 8)


@query
def missed_streak(b: Bank):
    return features.missed_streak(b.repayments(), TIE_BREAK)


@query
def transaction_features(b: Bank):
    return rounded(features.transaction_features(b.spending(), latest=b.latest_date()), SPEND_DIGITS)


@query
def transaction_features_all_customers(b: Bank):
    """Credit-only customers kept."""
    out = features.transaction_features(b.spending(), keep_credit_only=True, latest=b.latest_date())
    return rounded(out, SPEND_DIGITS)


@query
def monthly_activity(b: Bank):
    """Debit, credit and rows per customer and month of the trailing window."""
    return rounded(features.monthly_activity(features.recent(b.spending(), latest=b.latest_date())), 2)


@query
def ratio_features(b: Bank):
    return features.with_ratios(b.unlabelled()).select("customer_id", *features.RATIO_FEATURES)


@query
def feature_matrix(b: Bank):
    return rounded(features.one_hot(b.build_features(), b.levels()), SPEND_DIGITS, 6)


@query
def onehot(b: Bank):
    return features.one_hot(b.unlabelled().select("customer_id", *features.CATEGORICALS), b.levels())


@query
def portfolio_shape(b: Bank):
    return rounded(features.portfolio_shape(b.matrix()), 6)


@query
def loan_customer_repayments(b: Bank):
    """Repayment rows of customers with a loan (membership restriction)."""
    return rounded(b.repayments(), 4)


# -- scoring ----------------------------------------------------------------------

@query
def risk_score(b: Bank):
    return rounded(b.scored().select("customer_id", "raw_score", "risk_score"), 9)


@query
def risk_label(b: Bank):
    return b.customers().select("customer_id", "defaulted")


@query
def risk_tiers(b: Bank):
    return b.risk()


@query
def class_weights(b: Bank):
    return rounded(scoring.class_weights(b.customers()), 8)


@query
def what_if(b: Bank):
    base = features.with_ratios(b.customers().drop("risk_score"))
    joined = base.join(b.clv_values().select("customer_id", "estimated_clv", "default_probability"), "customer_id")
    out = scoring.what_if_rules(joined, SCENARIOS, b.risk_scale())
    return rounded(out, {"annual_revenue_est": 2, "simulated_clv": 2, "clv_change": 2}, 6)


@query
def stratified_split(b: Bank):
    return models.stratified_split(b.customers().select("customer_id", "defaulted"))


@query
def stratified_folds(b: Bank):
    return models.stratified_folds(b.customers().select("customer_id", "defaulted"))


# -- evaluation ---------------------------------------------------------------------

def _decided(b: Bank) -> DataFrame:
    scored = b.customers().select("customer_id", "defaulted", "risk_score")
    return scored.withColumn("predicted", scoring.predicted_label(F.col("risk_score")))


@query
def decisions(b: Bank):
    return _decided(b).select("customer_id", "predicted")


@query
def roc_auc(b: Bank):
    return rounded(evaluation.roc_auc(b.customers()), 9)


@query
def average_precision(b: Bank):
    return rounded(evaluation.average_precision(b.customers()), 9)


@query
def roc_curve(b: Bank):
    return rounded(evaluation.roc_curve(b.customers()), 9)


@query
def pr_curve(b: Bank):
    return rounded(evaluation.pr_curve(b.customers()), 9)


@query
def confusion(b: Bank):
    return evaluation.confusion(_decided(b), "defaulted", "predicted")


@query
def class_report(b: Bank):
    return rounded(evaluation.classification_report(_decided(b), "defaulted", "predicted"), 9)


@query
def linear_shap(b: Bank):
    values = segments.z_columns(b.scaler())
    means = dict.fromkeys(values, 0.0)
    return rounded(models.linear_shapley(b.cluster_inputs(), values, SHAP_WEIGHTS, means), 6)


# -- value --------------------------------------------------------------------------

@query
def clv_estimates(b: Bank):
    return rounded(b.clv_values(), {"default_probability": 4}, 2)


@query
def clv_tiers(b: Bank):
    return b.clv().select("customer_id", "clv_segment")


# -- the book and its dashboards -----------------------------------------------------

@query
def customer_360(b: Bank):
    return rounded(b.segmented_book(), 4)


@query
def kpis(b: Bank):
    return rounded(book.kpis(b.book()), {"default_rate": 6}, 2)


@query
def kpi_cards(b: Bank):
    return book.kpi_cards(book.kpis(b.book()))


@query
def pd_histogram(b: Bank):
    return rounded(distributions.histogram(b.risk(), "default_probability", 20), 6)


@query
def pd_histogram_25(b: Bank):
    return rounded(distributions.histogram(b.risk(), "default_probability", 25), 6)


@query
def clv_histogram_p99(b: Bank):
    return rounded(distributions.winsorised_histogram(b.clv_values(), "estimated_clv"), 4)


@query
def tier_counts(b: Bank):
    return book.tier_counts(b.risk())


@query
def segment_counts(b: Bank):
    return book.segment_counts(b.segments())


@query
def clv_tier_counts(b: Bank):
    return distributions.value_counts(b.clv(), "clv_segment")


@query
def clv_by_tier(b: Bank):
    return rounded(book.clv_by_tier(b.clv()), 2)


@query
def clv_tier_summary(b: Bank):
    return rounded(book.clv_tier_summary(b.clv()), {"pct_revenue": 1}, 2)


@query
def city_npa_rate(b: Bank):
    return book.city_npa_rate(b.customers())


@query
def city_npa_exposure(b: Bank):
    return rounded(book.city_npa_exposure(b.customers()), 2)


@query
def score_box_stats(b: Bank):
    return distributions.box_stats(b.unlabelled(), "employment_type", "credit_score")


@query
def employment_types(b: Bank):
    return distributions.distinct_sorted(b.unlabelled(), "employment_type")


@query
def risk_clv_quadrants(b: Bank):
    return rounded(distributions.quadrant_counts(b.clv_values()), {"avg_pd": 6}, 2)


@query
def filtered_customers(b: Bank):
    kept = book.filter_book(b.segmented_book(), city="NATION_7", tier="Medium Risk", segment="Growth")
    return rounded(kept.select("customer_id", "city", "risk_tier", "segment", "estimated_clv"), 2)


@query
def high_risk_table(b: Bank):
    return rounded(book.high_risk_table(b.book()), 4)


@query
def high_risk_top15(b: Bank):
    shown = ["customer_id", "city", "employment_type", "credit_score", "loan_amount", "default_probability",
             "risk_tier"]
    return rounded(book.high_risk_table(b.book(), 15, shown), 4)


@query
def drill_down(b: Bank):
    return rounded(book.drill_down(b.segmented_book()), 2)


@query
def customer_preview(b: Bank):
    return distributions.preview(b.unlabelled().select("customer_id", "city", "credit_score"), 100)


@query
def customer_sample(b: Bank):
    return distributions.sample_rows(b.unlabelled().select("customer_id", "credit_score"), 1200)


@query
def sample_per_segment(b: Bank):
    return distributions.sample_per_group(b.segments(), ["segment"], 500)


@query
def dashboard_documents(b: Bank):
    """Each dashboard panel as one JSON document."""
    panels = {
        "kpis": kpis(b), "pd_histogram": pd_histogram(b), "risk_tiers": tier_counts(b), "clv_by_tier": clv_by_tier(b),
        "city_npa": city_npa_rate(b), "score_box": score_box_stats(b), "high_risk": high_risk_table(b),
    }
    return functools.reduce(DataFrame.unionByName, [book.as_document(df, name) for name, df in panels.items()])


# -- segmentation ----------------------------------------------------------------------

@query
def zscore(b: Bank):
    return rounded(segments.zscore(b.cluster_inputs(), b.scaler()), 6)


@query
def assign_centroid(b: Bank):
    return b.segments()


@query
def segment_profile(b: Bank):
    return rounded(segments.profile_segments(b.segmented()), 3)


@query
def segment_headline(b: Bank):
    return rounded(segments.segment_headline(b.segmented()), 4)


@query
def segment_radar(b: Bank):
    return rounded(segments.segment_radar(b.segmented()), 6)


@query
def segment_radar_dash(b: Bank):
    return rounded(segments.segment_radar(b.segmented(), segments.RADAR_DASH), 6)


# -- forecasting -------------------------------------------------------------------------

@query
def monthly_revenue(b: Bank):
    return rounded(b.build_revenue(), 2)


@query
def monthly_revenue_by_category(b: Bank):
    return rounded(b.build_revenue("category"), 2)


@query
def dickey_fuller(b: Bank):
    return rounded(forecast.dickey_fuller(b.revenue()), 6)


@query
def dickey_fuller_by_category(b: Bank):
    return rounded(forecast.dickey_fuller(b.category_revenue(), ["category"]), 6)


@query
def augmented_dickey_fuller(b: Bank):
    return rounded(stationarity.augmented_dickey_fuller(b.revenue()), 6)


@query
def augmented_dickey_fuller_by_category(b: Bank):
    return rounded(stationarity.augmented_dickey_fuller(b.category_revenue(), ["category"]), 6)


@query
def seasonal_forecast(b: Bank):
    return rounded(forecast.seasonal_forecast(b.revenue()), 2)


@query
def seasonal_forecast_by_category(b: Bank):
    return rounded(forecast.seasonal_forecast(b.category_revenue(), by=["category"]), 2)


@query
def forecast_calendar(b: Bank):
    return forecast.forecast_calendar(b.category_revenue(), 12, ["category"])


@query
def forecast_union(b: Bank):
    monthly = b.revenue()
    return rounded(forecast.with_history(monthly, forecast.seasonal_forecast(monthly)), 2)


@query
def forecast_rows_ahead(b: Bank):
    """The forecast part of the combined table, split off by its type."""
    monthly = b.category_revenue()
    combined = forecast.with_history(monthly, forecast.seasonal_forecast(monthly, by=["category"]), ["category"])
    return rounded(combined.where(F.col("type") == "forecast"), 2)


@query
def arima_forecast(b: Bank):
    return rounded(forecast.arima_forecast(b.revenue()), 2)


@query
def arima_forecast_by_category(b: Bank):
    return rounded(forecast.arima_forecast(b.category_revenue(), by=["category"]), 2)


@query
def trend_forecast(b: Bank):
    return rounded(trend.trend_forecast(b.revenue()), 2)


@query
def trend_forecast_by_category(b: Bank):
    return rounded(trend.trend_forecast(b.category_revenue(), by=["category"]), 2)


@query
def trend_changes_by_category(b: Bank):
    return rounded(trend.trend_changes(trend.trend_fits(b.category_revenue(), ["category"]), ["category"]), 2)


@query
def trend_optimality_by_category(b: Bank):
    """Coefficients of each category's trend fit, and those that break the conditions of an optimum."""
    return trend.trend_optimality(b.category_revenue(), ["category"])


@query
def arima_exact(b: Bank):
    return rounded(arma.arima_exact(b.revenue()), 2)


@query
def arima_exact_by_category(b: Bank):
    return rounded(arma.arima_exact(b.category_revenue(), by=["category"]), 2)


# -- files -------------------------------------------------------------------------------------

def _through_file(b: Bank, df: DataFrame, table: str, fmt: str) -> DataFrame:
    """Write a table and scan it back with its declared schema."""
    path = f"{ensure_checkpoint_dir(b.spark)}/{table}-{uuid.uuid4().hex}.{fmt}"
    tables.write_table(df.select(*schemas.BY_NAME[table].names), path, fmt)
    return tables.read_table(b.spark, path, table, fmt)


@query
def csv_scan(b: Bank):
    return rounded(_through_file(b, b.customers(), "customers", "csv"), 4)


@query
def csv_scan_with_dates(b: Bank):
    return rounded(_through_file(b, b.revenue(), "monthly_revenue", "csv"), 2)


@query
def json_scan(b: Bank):
    return rounded(_through_file(b, b.clv(), "clv_estimates", "json"), 2)


@query
def uploaded_csv(b: Bank):
    """A CSV of unknown types replaces the working table."""
    path = f"{ensure_checkpoint_dir(b.spark)}/uploaded-{uuid.uuid4().hex}.csv"
    tables.write_table(b.risk(), path, "csv")
    uploaded = tables.read_uploaded_csv(b.spark, path)
    return (uploaded.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"),
                                              half_up(F.avg("credit_score"), 4).alias("avg_credit_score")))


# -- audit -----------------------------------------------------------------------------------

def _audited(b: Bank) -> dict[str, DataFrame]:
    return {"customers": b.unlabelled(), "repayment_history": b.repayments(), "transactions": b.spending(),
            "risk_scored": b.risk(), "clv_estimates": b.clv_values(), "customer_segments": b.segments()}


@query
def integrity_audit(b: Bank):
    return audit.integrity_audit(_audited(b))


# -- trained models --------------------------------------------------------------------------

def _scores(b: Bank, name: str) -> DataFrame:
    data, _ = b.training()
    return models.score(b.trained(name), data).select("customer_id", "split", "defaulted", "p_default", "predicted")


@query
def train_lr(b: Bank):
    return _scores(b, models.LOGISTIC)


@query
def train_rf(b: Bank):
    return _scores(b, models.FOREST)


@query
def train_gbt(b: Bank):
    return _scores(b, models.BOOSTING)


@query
def saved_model_scores(b: Bank):
    """Scores of the logistic model after saving and loading it."""
    path = f"{ensure_checkpoint_dir(b.spark)}/model-{uuid.uuid4().hex}"
    tables.save_model(b.trained(models.LOGISTIC), path)
    data, _ = b.training()
    return models.score(tables.load_model(path), data).select("customer_id", "p_default", "predicted")


@query
def cv_auc(b: Bank):
    """Five-fold AUC of the three models."""
    return b.comparison().select("model", "cv_auc_mean", "cv_auc_std")


@query
def model_comparison(b: Bank):
    """Hold-out and cross-validated metrics of the three models."""
    return b.comparison()


@query
def auc_target(b: Bank):
    return audit.auc_target(b.comparison())


@query
def feature_importance(b: Bank):
    _, inputs = b.training()
    return models.feature_importance(b.trained(models.FOREST), inputs, b.spark)


@query
def coefficient_importance(b: Bank):
    _, inputs = b.training()
    return models.feature_importance(b.trained(models.LOGISTIC), inputs, b.spark)


@query
def linear_model_shap(b: Bank):
    data, inputs = b.training()
    return rounded(models.explain(models.LOGISTIC, b.trained(models.LOGISTIC), data, inputs), 6)


@query
def mc_shapley(b: Bank):
    """Sampled contributions of the forest: an estimate for models of any kind."""
    data, inputs = b.training()
    return models.sampled_shapley(b.trained(models.FOREST), data.where(F.col("split") == "test"), inputs)


def _tree_values(b: Bank, name: str) -> tuple[DataFrame, list[str]]:
    data, inputs = b.training()
    paths = tree_shapley.model_paths(b.trained(name), b.spark)
    return tree_shapley.tree_contributions(paths, data.where(F.col("split") == "test"), inputs), inputs


@query
def tree_shap(b: Bank):
    """Exact mean contributions of the forest over all test rows."""
    return tree_shapley.mean_contributions(*_tree_values(b, models.FOREST))


@query
def tree_shap_boosting(b: Bank):
    return tree_shapley.mean_contributions(*_tree_values(b, models.BOOSTING))


@query
def tree_shap_gap(b: Bank):
    """Per tree model: test rows, and the largest distance of a row's summed contributions from its own prediction."""
    data, _ = b.training()
    parts = []
    for name in (models.FOREST, models.BOOSTING):
        scored = models.score(b.trained(name), data.where(F.col("split") == "test")).select("customer_id", "p_default")
        told = F.col("p_default") if name == models.FOREST else F.ln(F.col("p_default") / (1 - F.col("p_default")))
        parts.append(_tree_values(b, name)[0].join(scored, "customer_id").groupBy(F.lit(name).alias("model")).agg(
            F.count(F.lit(1)).alias("rows"), half_up(F.max(F.abs(F.col("explained") - told)), 6).alias("largest")))
    return functools.reduce(DataFrame.unionByName, parts)


@query
def rule_tree_shap(b: Bank):
    """Exact contributions of the fixed rule trees for every customer, covers counted from the customers."""
    paths = [p for nodes in tree_shapley.tree_covers(b.customers(), RULE_TREES, RULE_INPUTS) for p in tree_shapley.leaf_paths(nodes)]
    values = tree_shapley.tree_contributions(paths, b.customers(), RULE_INPUTS)
    return rounded(values.select("customer_id", *[F.col("phi")[i].alias(f"phi_{c}") for i, c in enumerate(RULE_INPUTS)], "explained"), 9)


@query
def shapley_gap(b: Bank):
    """Largest difference between a row's summed contributions and what they explain; zero up to rounding."""
    data, inputs = b.training()
    values = models.shapley_values(b.trained(models.LOGISTIC), data.where(F.col("split") == "test"), inputs, rounds=1)
    per_row = values.groupBy("customer_id").agg(F.abs(F.sum("phi") - F.max("gap")).alias("off"))
    return per_row.agg(F.count(F.lit(1)).alias("rows"), half_up(F.max("off"), 6).alias("largest"))


@query
def model_risk_tiers(b: Bank):
    """Tiers of the whole book under the trained logistic model."""
    data, _ = b.training()
    scored = models.score(b.trained(models.LOGISTIC), data)
    return scoring.assign_risk_tiers(scored, "p_default")


@query
def what_if_trained(b: Bank):
    """The scenarios under the trained logistic model, against its own base score."""
    data, _ = b.training()
    model = b.trained(models.LOGISTIC)
    base = models.score(model, data).withColumnRenamed("p_default", "default_probability")
    book_rows = base.join(b.clv_values().select("customer_id", "estimated_clv"), "customer_id")
    return rounded(scoring.what_if_model(book_rows, SCENARIOS, model, models.probability()), 6)


@query
def kmeans_segments(b: Bank):
    return segments.assign_segments(b.kmeans(), b.vectors(), b.scaler())


@query
def k_sweep(b: Bank):
    return segments.k_sweep(b.vectors())


@query
def pca_projection(b: Bank):
    """First two components of every row, with the share of the variance each explains."""
    projected, shares = segments.pca_projection(b.vectors())
    return projected.withColumns({f"share{i + 1}": F.lit(v) for i, v in enumerate(shares)})


# -- statements about trained models, whose right sides the SQL twins derive from the tables ------

@query
def trained_rows(b: Bank):
    """Rows, defaults and wrong decisions per model, split and fold of the training table."""
    data, _ = b.training()
    parts = []
    for name in (models.LOGISTIC, models.FOREST, models.BOOSTING):
        scored = models.score(b.trained(name), data)
        wrong = F.col("predicted") != F.when(F.col("p_default") >= F.lit(0.40), 1).otherwise(0)
        outside = ~F.col("p_default").between(0, 1) | F.col("p_default").isNull()
        parts.append(scored.groupBy(F.lit(name).alias("model"), "split", "fold").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("defaulted").cast("long").alias("defaults"),
            F.sum((wrong | outside).cast("long")).alias("faults")))
    return functools.reduce(DataFrame.unionByName, parts)


@query
def saved_model_gap(b: Bank):
    """Customers scored by the saved model, and those whose score it changes."""
    own = _scores(b, models.LOGISTIC).select("customer_id", F.col("p_default").alias("p"))
    return saved_model_scores(b).join(own, "customer_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum((F.abs(F.col("p_default") - F.col("p")) > 1e-12).cast("long")).alias("changed"))


@query
def model_tier_rows(b: Bank):
    """Customers in the tiers of the trained model, and those whose tier does not follow from the exported probability."""
    tiers = model_risk_tiers(b)
    p = F.col("default_probability")
    told = F.when(p <= 0, None).when(p <= 0.30, "Low").when(p <= 0.60, "Medium").otherwise("High")
    # A probability within rounding of a bound may fall to either side of it.
    near = (F.abs(p - 0.30) <= 1e-4) | (F.abs(p - 0.60) <= 1e-4) | (p <= 1e-4)
    wrong = ~near & ~F.substring(F.col("risk_tier"), 1, 3).eqNullSafe(F.substring(told, 1, 3))
    return tiers.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("customer_id").alias("customers"), F.sum(wrong.cast("long")).alias("wrong"))


@query
def kmeans_fixed_point(b: Bank):
    """Customers clustered, and clusters whose centre is not the mean of its rows (to two digits)."""
    model = b.kmeans()
    x = vector_to_array("features")
    clustered = model.transform(b.vectors()).withColumn("x", x)
    size = len(model.clusterCenters()[0])
    means = clustered.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(size)])
    centres = b.spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())], "prediction int, c array<double>")
    off = F.greatest(*[F.abs(F.col(f"m{i}") - F.col("c")[i]) for i in range(size)])
    return means.join(centres, "prediction").agg(F.sum("n").alias("rows"), F.sum((off > 0.01).cast("long")).alias("astray"))


@query
def pca_axes(b: Bank):
    """Correlation of the first two components, the variance along them over all variance, and the shares stated."""
    projected = pca_projection(b)
    total = len(segments.CLUSTER_FEATURES)
    return projected.agg(
        F.count(F.lit(1)).alias("rows"), F.abs(half_up(F.corr("pc1", "pc2"), 6)).alias("correlation"),
        half_up(F.abs(F.var_samp("pc1") / F.var_samp("pc2") - F.max("share1") / F.max("share2")), 4).alias("off"))
