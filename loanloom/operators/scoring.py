"""Rules-based risk score, labels, tiers and whole-book scenario scoring."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions import bands
from loanloom.functions.columns import clip, flag, half_even, ratio_or, stable_hash
from loanloom.operators.clv import annual_revenue, lifetime_value
from loanloom.operators.ordered import quantile_values

# Weights of the risk score and its low-income edge.
WEIGHTS = {"score": 0.40, "unemployed": 0.20, "instalment": 0.15,
           "utilisation": 0.12, "low_income": 0.08, "loan": 0.05}
LOW_INCOME = 250000
EPSILON = 1e-9
DECISION_THRESHOLD = 0.40


class RiskScale(NamedTuple):
    """Range of the raw score over the book the scorer was fitted on."""

    low: float
    high: float


class LabelCuts(NamedTuple):
    """Scores at or below ``good`` never default, at or above ``bad`` always."""

    good: float
    bad: float


def raw_risk() -> Column:
    """Weighted sum of six risk drivers, before normalisation."""
    instalment = ratio_or(F.col("loan_amount"), F.col("loan_tenure_months"))
    burden = clip(clip(instalment / F.greatest(F.col("income") / 12, F.lit(1.0)), 0, 5), 0, 1)
    used = clip(ratio_or(F.col("cc_balance"), F.col("credit_limit")), 0, 1)
    standing = (F.col("credit_score") - 300) / 600
    return (F.lit(WEIGHTS["score"]) * (1 - standing)
            + F.lit(WEIGHTS["unemployed"]) * flag(F.col("employment_type") == "Unemployed")
            + F.lit(WEIGHTS["instalment"]) * burden
            + F.lit(WEIGHTS["utilisation"]) * used
            + F.lit(WEIGHTS["low_income"]) * flag(F.col("income") < LOW_INCOME)
            + F.lit(WEIGHTS["loan"]) * F.col("has_loan"))


def fit_risk_scale(customers: DataFrame, raw: Column | None = None) -> RiskScale:
    """Range of the raw score; ``raw`` names a column that already holds it."""
    raw = raw_risk() if raw is None else raw
    row = customers.agg(F.min(raw).alias("low"), F.max(raw).alias("high")).first()
    return RiskScale(row["low"], row["high"])


def risk_score(scale: RiskScale, raw: Column | None = None) -> Column:
    """Raw score mapped to [0, 1] by the fitted range."""
    raw = raw_risk() if raw is None else raw
    return (raw - F.lit(scale.low)) / (F.lit(scale.high) - F.lit(scale.low) + F.lit(EPSILON))


def fit_label_cuts(scored: DataFrame, score: str = "risk_score") -> LabelCuts:
    good, bad = quantile_values(scored, score, [0.45, 0.55])
    return LabelCuts(good, bad)


def default_label(score: Column, cuts: LabelCuts, coin: Column | None = None) -> Column:
    """1 above the upper cut, 0 below the lower one, a coin toss in between.

    The default coin is a hash of the customer id, so a retried task tosses the same.
    """
    if coin is None:
        coin = stable_hash(F.col("customer_id"), 42) % 2
    return (F.when(score >= cuts.bad, F.lit(1))
             .when(score <= cuts.good, F.lit(0))
             .otherwise(coin)).cast("long")


def with_label(customers: DataFrame, scale: RiskScale, cuts: LabelCuts, coin: Column | None = None) -> DataFrame:
    """Add ``risk_score`` and ``defaulted``."""
    scored = customers.withColumn("risk_score", risk_score(scale))
    return scored.withColumn("defaulted", default_label(F.col("risk_score"), cuts, coin))


def assign_risk_tiers(df: DataFrame, probability: str) -> DataFrame:
    """Score table of the whole book: probability to 4 digits, tier from the unrounded one."""
    p = F.col(probability)
    return df.select("customer_id", "credit_score", "income", "defaulted",
                     half_even(p, 4).alias("default_probability"),
                     bands.risk_tier(p).alias("risk_tier"))


def class_weights(df: DataFrame, label: str = "defaulted") -> DataFrame:
    """Balanced weight ``n / (classes * n_class)`` per label value."""
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("support"))
    every_class = Window.partitionBy()
    rows, classes = F.sum("support").over(every_class), F.count(F.lit(1)).over(every_class)
    return per_class.withColumn("class_weight", rows / (classes * F.col("support")))


def predicted_label(probability: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return flag(probability >= threshold)


# -- scenarios ----------------------------------------------------------------

# Inputs a scenario may override; anything else stays at the customer's value.
# Columns of a scenario.
SCENARIO_INPUTS = ["loan_amount", "credit_utilisation_ratio", "income", "credit_score",
                   "repayment_consistency_score", "total_missed_payments"]


def expand_scenarios(book: DataFrame, scenarios: dict[str, dict[str, str]],
                     recompute_all: bool = False) -> DataFrame:
    """One row per customer and scenario, with the overridden inputs applied.

    ``scenarios`` maps a name to ``{input: SQL expression over the base row}``,
    e.g. ``{"income_cut": {"income": "income * 0.8"}}``.  The scenario list
    is a literal array exploded in place, so no join takes place.  Only the income-to-loan ratio is
    refreshed, as in the interactive simulator; ``recompute_all``
    also refreshes the instalment ratio and the interest burden.
    """
    if not scenarios:
        raise ValueError("no scenarios given")
    for name, changes in scenarios.items():
        unknown = set(changes) - set(SCENARIO_INPUTS)
        if unknown:
            raise ValueError(f"scenario {name} overrides unknown inputs {sorted(unknown)}")
    inputs = [c for c in SCENARIO_INPUTS if c in book.columns]
    kinds = {f.name: f.dataType for f in book.schema}
    rows = [F.struct(F.lit(name).alias("scenario"),
                     *[F.expr(changes.get(c, f"`{c}`")).cast(kinds[c]).alias(c) for c in inputs])
            for name, changes in scenarios.items()]
    exploded = book.withColumn("__case", F.explode(F.array(*rows)))
    out = exploded.withColumn("scenario", F.col("__case.scenario")).withColumns(
        {c: F.col(f"__case.{c}") for c in inputs}).drop("__case")
    if "income_to_loan_ratio" in book.columns:
        out = out.withColumn("income_to_loan_ratio",
                             F.col("income") / F.greatest(F.col("loan_amount"), F.lit(1.0)))
    if recompute_all:
        has_loan = F.col("loan_amount") > 0
        instalment = ratio_or(F.col("loan_amount"), F.col("loan_tenure_months"))
        out = out.withColumns({
            "emi_to_income_ratio": ratio_or(instalment, F.col("income") / 12, when=has_loan),
            "interest_burden_score": F.col("interest_rate_pct") / 100 * F.col("loan_amount"),
        })
    return out


def simulate(scored: DataFrame, probability: Column) -> DataFrame:
    """Decision columns for expanded scenarios whose probability is at hand.

    Needs the base ``default_probability`` and ``estimated_clv``; a customer
    without them shows a zero change, as the simulator falls back to the new value.
    """
    staged = scored.withColumn("simulated_probability", probability)
    p = F.col("simulated_probability")
    staged = staged.withColumn(
        "annual_revenue_est",
        annual_revenue(F.col("loan_amount"), F.col("interest_rate_pct"), F.col("credit_limit"), F.col("income")))
    staged = staged.withColumn("simulated_clv", lifetime_value(F.col("annual_revenue_est"), F.col("tenure_months"), p))
    return staged.select(
        "customer_id", "scenario", "simulated_probability",
        (p - F.coalesce("default_probability", p)).alias("probability_change"),
        bands.what_if_tier(p).alias("risk_tier"),
        "annual_revenue_est", "simulated_clv",
        (F.col("simulated_clv") - F.coalesce("estimated_clv", "simulated_clv")).alias("clv_change"),
        bands.recommendation(p).alias("recommendation"),
    )


def what_if_rules(book: DataFrame, scenarios: dict[str, dict[str, str]], scale: RiskScale) -> DataFrame:
    """Scenario scoring with the rules score, clipped to [0, 1]."""
    # The rules read the balance and the loan flag, not the ratios derived from them.
    expanded = expand_scenarios(book, scenarios).withColumns({
        "cc_balance": F.col("credit_utilisation_ratio") * F.col("credit_limit"),
        "has_loan": flag(F.col("loan_amount") > 0),
    })
    return simulate(expanded, clip(risk_score(scale), 0, 1))


def what_if_model(book: DataFrame, scenarios: dict[str, dict[str, str]], model, probability: Column,
                  recompute_all: bool = False) -> DataFrame:
    """Scenario scoring with a fitted model in one batch ``transform``."""
    expanded = expand_scenarios(book, scenarios, recompute_all)
    return simulate(model.transform(expanded), probability)
