"""Customer lifetime value and its quartile tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions import bands
from loanloom.functions.columns import clip, half_even
from loanloom.operators.ordered import quantile_values

# Fee rates, shortest tenure in years, default probability of an unscored customer.
CARD_FEE = 0.02
TRANSACTION_FEE = 0.003
MIN_YEARS = 0.5
UNSCORED_PD = 0.10


def annual_revenue(loan: Column, rate_pct: Column, limit: Column, income: Column) -> Column:
    """Interest, card fee and transaction fee per year; 0 if any part is unknown."""
    total = loan * (rate_pct / 100) + limit * F.lit(CARD_FEE) + income * F.lit(TRANSACTION_FEE)
    return F.coalesce(total, F.lit(0.0))


def lifetime_value(revenue: Column, tenure_months: Column, probability: Column) -> Column:
    """Revenue over the tenure, weighted by the chance of survival."""
    return revenue * clip(tenure_months / 12, MIN_YEARS) * (1 - probability)


def estimate_clv(customers: DataFrame, risk: DataFrame) -> DataFrame:
    """Lifetime value per customer; customers without a score are kept."""
    pd = risk.select("customer_id", "default_probability")
    base = customers.select("customer_id", "loan_amount", "interest_rate_pct", "credit_limit", "income",
                            "tenure_months").join(pd, "customer_id", "left")
    revenue = annual_revenue(F.col("loan_amount"), F.col("interest_rate_pct"),
                             F.col("credit_limit"), F.col("income"))
    staged = base.withColumn("annual_revenue_est", revenue)
    value = lifetime_value(F.col("annual_revenue_est"), F.col("tenure_months"),
                           F.coalesce("default_probability", F.lit(UNSCORED_PD)))
    return staged.select("customer_id", half_even(value, 2).alias("estimated_clv"),
                         "annual_revenue_est", "default_probability")


def fit_clv_cuts(clv: DataFrame) -> list[float]:
    """Exact quartiles of the estimated value."""
    return quantile_values(clv, "estimated_clv", [0.25, 0.50, 0.75])


def with_clv_tier(clv: DataFrame, cuts: list[float]) -> DataFrame:
    return clv.select("customer_id", "estimated_clv",
                      bands.quartile_tier(F.col("estimated_clv"), cuts).alias("clv_segment"),
                      "annual_revenue_est", "default_probability")
