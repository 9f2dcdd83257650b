"""The twelve portfolio reports and the dashboard variants that differ from them.

Reports that follow the SQL wording are canonical.  A ``*_dash`` function is the
dashboard's version of the same report where its result differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions import bands
from loanloom.functions.columns import count_where, half_up, month_of, pct, sum_where
from loanloom.operators.distributions import top_k
from loanloom.operators.features import select_present

CHURNER_SEGMENT = 3


def _mean(column: str, digits: int) -> Column:
    return half_up(F.avg(column), digits)


def _default_rate() -> Column:
    return half_up(F.avg("defaulted") * 100, 2)


def _npa() -> Column:
    return sum_where(F.col("defaulted") == 1, F.col("loan_amount"))


def _people() -> Column:
    return F.count(F.lit(1))


def _all_bands(spark_df: DataFrame, column: str, labels: list[str], report: DataFrame) -> DataFrame:
    """Left-join a report onto its full band list, so empty bands show up too."""
    every = spark_df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias(column))
    return every.join(report, column, "left")


# -- Q1 ----------------------------------------------------------------------

def default_by_employment(customers: DataFrame) -> DataFrame:
    return (customers.groupBy("employment_type").agg(
        _people().alias("total_customers"),
        F.sum("defaulted").alias("total_defaults"),
        _default_rate().alias("default_rate_pct"),
        _mean("credit_score", 0).alias("avg_credit_score"),
        _mean("income", 2).alias("avg_income"),
        _mean("loan_amount", 2).alias("avg_loan_amount"),
    ).orderBy(F.desc("default_rate_pct"), "employment_type"))


def default_by_employment_dash(customers: DataFrame) -> DataFrame:
    """No average loan; means are left unrounded."""
    return (customers.groupBy("employment_type").agg(
        F.count("customer_id").alias("total_customers"),
        F.sum("defaulted").alias("total_defaults"),
        _default_rate().alias("default_rate_pct"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.avg("income").alias("avg_income"),
    ).orderBy(F.desc("default_rate_pct"), "employment_type"))


# -- Q2 ----------------------------------------------------------------------

def high_risk_customers(customers: DataFrame, risk: DataFrame, segments: DataFrame, k: int = 100) -> DataFrame:
    """Riskiest borrowers of the top tier, for outreach."""
    flagged = risk.where(F.col("risk_tier") == "High Risk").select(
        "customer_id", "default_probability", "risk_tier")
    joined = (customers.where(F.col("has_loan") == 1)
              .select("customer_id", "city", "employment_type", "credit_score", "income", "loan_amount")
              .join(flagged, "customer_id").join(segments, "customer_id"))
    return top_k(joined, "default_probability", k)


def high_risk_customers_dash(book: DataFrame, k: int = 20) -> DataFrame:
    """Any top-tier customer, with or without a loan; absent columns are skipped."""
    shown = ["customer_id", "city", "employment_type", "credit_score", "income", "loan_amount",
             "default_probability", "risk_tier"]
    return top_k(select_present(book.where(F.col("risk_tier") == "High Risk"), shown), "default_probability", k)


# -- Q3 ----------------------------------------------------------------------

def emi_collection(repayments: DataFrame) -> DataFrame:
    """Billed against collected instalments per month."""
    status = F.col("payment_status")
    return (repayments.groupBy(month_of(F.col("due_date")).alias("repayment_month")).agg(
        _people().alias("total_emi_dues"),
        F.sum("emi_amount").alias("total_emi_billed"),
        F.sum("paid_amount").alias("total_collected"),
        half_up(pct(F.sum("paid_amount"), F.sum("emi_amount")), 2).alias("collection_rate_pct"),
        count_where(status == "Missed").alias("missed_payments"),
        count_where(status == "Late").alias("late_payments"),
    ).orderBy(F.desc("repayment_month")))


def emi_collection_dash(repayments: DataFrame) -> DataFrame:
    """Without the number of dues."""
    return emi_collection(repayments).drop("total_emi_dues")


# -- Q4 ----------------------------------------------------------------------

def utilisation_bands(customers: DataFrame) -> DataFrame:
    used = bands.utilisation(F.col("cc_balance"), F.col("credit_limit"))
    return (customers.where(F.col("has_credit_card") == 1)
            .groupBy(bands.left_closed(used, bands.UTILISATION_SQL).alias("utilisation_band")).agg(
                _people().alias("customer_count"),
                _default_rate().alias("default_rate_pct"),
                _mean("credit_score", 0).alias("avg_credit_score"),
            ).orderBy(F.desc("default_rate_pct"), "utilisation_band"))


def utilisation_bands_dash(customers: DataFrame) -> DataFrame:
    """Right-closed bands over everyone; no utilisation, no band; empty bands listed."""
    used = bands.utilisation(F.col("cc_balance"), F.col("credit_limit"))
    banded = customers.withColumn("utilisation_band", bands.right_closed(used, bands.UTILISATION_DASH))
    report = banded.where(F.col("utilisation_band").isNotNull()).groupBy("utilisation_band").agg(
        F.count("customer_id").alias("n"), _default_rate().alias("default_rate_pct"),
        F.avg("credit_score").alias("avg_credit_score"))
    return (_all_bands(customers, "utilisation_band", bands.UTILISATION_DASH[1], report)
            .select("utilisation_band", F.coalesce("n", F.lit(0)).alias("customer_count"),
                    "default_rate_pct", "avg_credit_score")
            .orderBy(F.desc_nulls_last("default_rate_pct"), "utilisation_band"))


# -- Q5 ----------------------------------------------------------------------

def city_npa(customers: DataFrame) -> DataFrame:
    """Loan exposure and its defaulted part per city."""
    return (customers.where(F.col("has_loan") == 1).groupBy("city").agg(
        _people().alias("total_customers"),
        F.sum("loan_amount").alias("total_loan_exposure"),
        _npa().alias("npa_exposure"),
        half_up(pct(_npa(), F.sum("loan_amount")), 2).alias("npa_rate_pct"),
        _mean("credit_score", 0).alias("avg_credit_score"),
    ).orderBy(F.desc("npa_exposure"), "city"))


def city_npa_dash(customers: DataFrame) -> DataFrame:
    """A city without exposure gets rate 0 instead of NULL."""
    exposure = F.greatest(F.sum("loan_amount"), F.lit(1.0))
    return (customers.where(F.col("has_loan") == 1).groupBy("city").agg(
        _people().alias("total_customers"),
        F.sum("loan_amount").alias("total_loan_exposure"),
        _npa().alias("npa_exposure"),
        half_up(_npa() / exposure * 100, 2).alias("npa_rate_pct"),
        _mean("credit_score", 0).alias("avg_credit_score"),
    ).orderBy(F.desc("npa_exposure"), "city"))


# -- Q6 ----------------------------------------------------------------------

def category_spend(transactions: DataFrame) -> DataFrame:
    return (transactions.groupBy("category", "transaction_type").agg(
        _people().alias("txn_count"),
        half_up(F.sum("amount"), 2).alias("total_volume"),
        _mean("amount", 2).alias("avg_txn_amount"),
        half_up(F.stddev_samp("amount"), 2).alias("txn_amount_stddev"),
    ).orderBy(F.desc("total_volume"), "category", "transaction_type"))


def category_spend_dash(transactions: DataFrame, k: int = 20) -> DataFrame:
    """Largest pairs by volume, without the spread."""
    return (transactions.groupBy("category", "transaction_type").agg(
        F.count("amount").alias("txn_count"),
        F.sum("amount").alias("total_volume"),
        F.avg("amount").alias("avg_txn_amount"),
    ).orderBy(F.desc("total_volume"), "category", "transaction_type").limit(k))


# -- Q7 ----------------------------------------------------------------------

def clv_distribution(clv: DataFrame) -> DataFrame:
    """Customers and value per tier; the share is taken over the few tier rows."""
    per_tier = clv.groupBy("clv_segment").agg(
        _people().alias("customer_count"),
        F.avg("estimated_clv").alias("mean"),
        F.sum("estimated_clv").alias("total"),
        half_up(F.avg("default_probability") * 100, 2).alias("avg_default_prob_pct"))
    everything = F.sum("total").over(Window.partitionBy())
    return per_tier.select(
        "clv_segment", "customer_count",
        half_up(F.col("mean"), 2).alias("avg_clv"),
        half_up(F.col("total"), 2).alias("total_clv"),
        half_up(pct(F.col("total"), everything), 2).alias("pct_of_total_clv"),
        "avg_default_prob_pct",
    ).orderBy(F.desc("avg_clv"))


def clv_distribution_dash(book: DataFrame) -> DataFrame:
    """Only the share is rounded, and there is no probability."""
    per_tier = book.where(F.col("clv_segment").isNotNull()).groupBy("clv_segment").agg(
        F.count("estimated_clv").alias("customer_count"),
        F.avg("estimated_clv").alias("avg_clv"),
        F.sum("estimated_clv").alias("total_clv"))
    everything = F.sum("total_clv").over(Window.partitionBy())
    return per_tier.withColumn("pct_of_total", half_up(pct(F.col("total_clv"), everything), 2)
                               ).orderBy(F.desc("avg_clv"))


# -- Q8 ----------------------------------------------------------------------

def rolling_defaults(repayments: DataFrame) -> DataFrame:
    """Customers with a missed payment per month and their three-row mean.

    The window runs over month rows, after all customer rows have been folded.
    """
    monthly = (repayments.where(F.col("payment_status") == "Missed")
               .groupBy(month_of(F.col("due_date")).alias("month"))
               .agg(F.countDistinct("customer_id").alias("defaulting_customers")))
    last_three = Window.orderBy("month").rowsBetween(-2, Window.currentRow)
    return monthly.select("month", "defaulting_customers",
                          half_up(F.avg("defaulting_customers").over(last_three), 1).alias("rolling_3m_avg")
                          ).orderBy("month")


# -- Q9 ----------------------------------------------------------------------

def _repaying(customers: DataFrame, repayments: DataFrame) -> DataFrame:
    """Repayments folded to one row per customer before they meet the customer table."""
    folded = repayments.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("dues"), count_where(F.col("payment_status") == "On-Time").alias("on_time"))
    return customers.select("customer_id", "tenure_months", "credit_score").join(folded, "customer_id")


def _by_dues(column: str) -> Column:
    """Mean over repayment rows, from one row per customer."""
    known = F.when(F.col(column).isNotNull(), F.col("dues"))
    return F.sum(F.col(column) * F.col("dues")) / F.sum(known)


def tenure_cohorts(customers: DataFrame, repayments: DataFrame) -> DataFrame:
    """On-time rate by tenure; means weigh a customer by its number of dues."""
    band = bands.left_closed(F.col("tenure_months"), bands.TENURE_SQL).alias("tenure_band")
    return (_repaying(customers, repayments).groupBy(band).agg(
        F.countDistinct("customer_id").alias("customers"),
        half_up(F.sum("on_time") / F.sum("dues") * 100, 2).alias("on_time_rate_pct"),
        half_up(_by_dues("credit_score"), 0).alias("avg_credit_score"),
    ).orderBy(F.desc("on_time_rate_pct"), "tenure_band"))


def tenure_cohorts_dash(customers: DataFrame, repayments: DataFrame) -> DataFrame:
    """Right-closed bands in band order, empty ones listed."""
    band = bands.right_closed(F.col("tenure_months"), bands.TENURE_DASH)
    report = (_repaying(customers, repayments).withColumn("tenure_band", band)
              .where(F.col("tenure_band").isNotNull()).groupBy("tenure_band").agg(
                  F.countDistinct("customer_id").alias("n"),
                  half_up(F.sum("on_time") / F.sum("dues") * 100, 2).alias("on_time_rate_pct"),
                  _by_dues("credit_score").alias("avg_credit_score")))
    labels = bands.TENURE_DASH[1]
    return (_all_bands(customers, "tenure_band", labels, report)
            .select("tenure_band", F.coalesce("n", F.lit(0)).alias("customers"),
                    "on_time_rate_pct", "avg_credit_score")
            .orderBy(bands.band_order(labels, F.col("tenure_band"))))


# -- Q10 ---------------------------------------------------------------------

def cross_sell_targets(customers: DataFrame, clv: DataFrame, risk: DataFrame, k: int = 20) -> DataFrame:
    """Safe customers of the two best value tiers, by value."""
    safe = risk.where(F.col("risk_tier") == "Low Risk").select("customer_id", "default_probability", "risk_tier")
    rich = clv.where(F.col("clv_segment").isin("Gold", "Platinum")).select(
        "customer_id", "estimated_clv", "clv_segment")
    joined = (customers.select("customer_id", "city", "employment_type", "credit_score")
              .join(rich, "customer_id").join(safe, "customer_id"))
    return top_k(joined, "estimated_clv", k)


def cross_sell_targets_dash(book: DataFrame, k: int = 20) -> DataFrame:
    shown = ["customer_id", "city", "employment_type", "credit_score", "estimated_clv", "clv_segment",
             "default_probability"]
    picked = book.where((F.col("risk_tier") == "Low Risk") & F.col("clv_segment").isin("Gold", "Platinum"))
    return top_k(select_present(picked, shown), "estimated_clv", k)


# -- Q11 ---------------------------------------------------------------------

def income_bands(customers: DataFrame) -> DataFrame:
    band = bands.left_closed(F.col("income"), bands.INCOME_SQL).alias("income_band")
    return (customers.where(F.col("has_loan") == 1).groupBy(band).agg(
        _people().alias("total_customers"),
        F.sum("defaulted").alias("total_defaults"),
        _default_rate().alias("default_rate_pct"),
        _mean("credit_score", 0).alias("avg_credit_score"),
        _mean("loan_amount", 2).alias("avg_loan_amount"),
        half_up(_npa(), 2).alias("npa_exposure"),
        half_up(pct(_npa(), F.sum("loan_amount")), 2).alias("npa_rate_pct"),
    ).orderBy(F.desc("default_rate_pct"), "income_band"))


def income_bands_dash(customers: DataFrame) -> DataFrame:
    """Right-closed bands, no loan mean and no rate of exposure; empty bands listed."""
    band = bands.right_closed(F.col("income"), bands.INCOME_DASH)
    report = (customers.where(F.col("has_loan") == 1).withColumn("income_band", band)
              .where(F.col("income_band").isNotNull()).groupBy("income_band").agg(
                  F.count("customer_id").alias("n"), F.sum("defaulted").alias("defaults"),
                  _default_rate().alias("default_rate_pct"),
                  F.avg("credit_score").alias("avg_credit_score"), _npa().alias("npa")))
    return (_all_bands(customers, "income_band", bands.INCOME_DASH[1], report)
            .select("income_band", F.coalesce("n", F.lit(0)).alias("total_customers"),
                    F.coalesce("defaults", F.lit(0)).alias("total_defaults"), "default_rate_pct",
                    "avg_credit_score", F.coalesce("npa", F.lit(0.0)).alias("npa_exposure"))
            .orderBy(F.desc_nulls_last("default_rate_pct"), "income_band"))


# -- Q12 ---------------------------------------------------------------------

def churner_clv_by_city(customers: DataFrame, risk: DataFrame, clv: DataFrame, segments: DataFrame,
                        segment: int = CHURNER_SEGMENT) -> DataFrame:
    """Value at stake in the churning segment per city."""
    base = (customers.select("customer_id", "city", "income", "credit_score", "tenure_months")
            .join(segments.where(F.col("segment") == segment).select("customer_id"), "customer_id")
            .join(risk.select("customer_id", "default_probability"), "customer_id")
            .join(clv.select("customer_id", "estimated_clv"), "customer_id"))
    return (base.groupBy("city").agg(
        _people().alias("churner_count"),
        half_up(F.avg("default_probability") * 100, 2).alias("avg_default_prob_pct"),
        _mean("estimated_clv", 2).alias("avg_clv"),
        half_up(F.sum("estimated_clv"), 2).alias("total_clv_at_risk"),
        _mean("credit_score", 0).alias("avg_credit_score"),
        _mean("income", 2).alias("avg_income"),
        _mean("tenure_months", 1).alias("avg_tenure_months"),
    ).orderBy(F.desc("total_clv_at_risk"), "city"))


def churner_clv_by_city_dash(book: DataFrame, segment: int = CHURNER_SEGMENT) -> DataFrame:
    """Means other than the probability are left unrounded; no income or tenure."""
    return (book.where(F.col("segment") == segment).groupBy("city").agg(
        F.count("customer_id").alias("churner_count"),
        half_up(F.avg("default_probability") * 100, 2).alias("avg_default_prob_pct"),
        F.avg("estimated_clv").alias("avg_clv"),
        F.sum("estimated_clv").alias("total_clv_at_risk"),
        F.avg("credit_score").alias("avg_credit_score"),
    ).orderBy(F.desc("total_clv_at_risk"), "city"))
