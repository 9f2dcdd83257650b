"""The customer-360 book and the aggregates that dashboards read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions import bands
from loanloom.functions.columns import as_percent, as_rupees, count_where, half_even, sum_where
from loanloom.operators.distributions import top_k, value_counts
from loanloom.operators.features import select_present

# Short segment names of the dashboard and long ones of the profile report.
SEGMENT_SHORT = {0: "Premium", 1: "Vulnerable", 2: "Growth", 3: "Churner"}
SEGMENT_LONG = {
    0: "Premium — High Value, Low Risk",
    1: "Vulnerable — Low Income, High Risk",
    2: "Growth Potential — Young, Credit-Building",
    3: "Churner Watch — Declining Engagement",
}


def customer_360(customers: DataFrame, risk: DataFrame | None = None, clv: DataFrame | None = None,
                 segments: DataFrame | None = None, skip_empty: bool = False) -> DataFrame:
    """Customers with whichever model outputs exist.  Every side has one row per customer.

    An empty side gives NULL columns; with ``skip_empty`` it gives none, at the
    price of a look at each side.
    """
    wanted = [(risk, ["default_probability", "risk_tier"]), (clv, ["estimated_clv", "clv_segment"]),
              (segments, ["segment"])]
    book = customers
    for side, columns in wanted:
        absent = side is None or not set(columns) <= set(side.columns) or (skip_empty and side.isEmpty())
        if not absent:
            book = book.join(side.select("customer_id", *columns), "customer_id", "left")
    return book


def filter_book(book: DataFrame, city: str = "All", tier: str = "All", segment: str = "All") -> DataFrame:
    """Dashboard filters; ``All`` and filters on absent columns do nothing."""
    ids = {name: number for number, name in SEGMENT_SHORT.items()}
    for column, value, wanted in (("city", city, city), ("risk_tier", tier, tier),
                                  ("segment", segment, ids.get(segment, -1))):
        if value != "All" and column in book.columns:
            book = book.where(F.col(column) == wanted)
    return book


def segment_name(segment: Column, names: dict[int, str] = SEGMENT_SHORT, default: str = "Unknown") -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(lookup[segment], F.lit(default))


def kpis(book: DataFrame) -> DataFrame:
    """All headline numbers in a single pass over the book."""
    return book.agg(
        F.count(F.lit(1)).alias("total_customers"),
        count_where(F.col("risk_tier") == "High Risk").alias("high_risk_customers"),
        F.avg("defaulted").alias("default_rate"),
        F.avg("estimated_clv").alias("avg_clv"),
        F.sum("loan_amount").alias("total_loan_exposure"),
        F.rint(F.avg("credit_score")).cast("long").alias("avg_credit_score_rounded"),
        F.avg("credit_score").cast("long").alias("avg_credit_score_truncated"),
        count_where(F.col("clv_segment") == "Platinum").alias("platinum_customers"),
    )


def kpi_cards(numbers: DataFrame) -> DataFrame:
    """The headline numbers as display text."""
    return numbers.select(
        F.format_number("total_customers", 0).alias("total_customers"),
        F.format_number("high_risk_customers", 0).alias("high_risk_customers"),
        as_percent(F.col("default_rate")).alias("default_rate"),
        as_rupees(F.col("avg_clv")).alias("avg_clv"),
        as_rupees(F.col("total_loan_exposure")).alias("total_loan_exposure"),
        F.col("avg_credit_score_rounded").cast("string").alias("avg_credit_score"),
        F.format_number("platinum_customers", 0).alias("platinum_customers"),
    )


def tier_counts(book: DataFrame) -> DataFrame:
    return value_counts(book, "risk_tier")


def segment_counts(book: DataFrame) -> DataFrame:
    named = book.where(F.col("segment").isNotNull()).select(segment_name(F.col("segment")).alias("segment"))
    return value_counts(named.where(F.col("segment") != "Unknown"), "segment")


def clv_by_tier(book: DataFrame) -> DataFrame:
    """Mean value per tier in tier order; tiers without customers are left out."""
    return (book.where(F.col("clv_segment").isNotNull()).groupBy("clv_segment")
                .agg(F.avg("estimated_clv").alias("avg_clv"))
                .orderBy(bands.band_order(bands.CLV_TIERS, F.col("clv_segment"))))


def clv_tier_summary(book: DataFrame) -> DataFrame:
    """Count, mean, sum and share of the value per tier."""
    per_tier = book.where(F.col("clv_segment").isNotNull()).groupBy("clv_segment").agg(
        F.count("estimated_clv").alias("customers"), F.avg("estimated_clv").alias("avg_clv"),
        F.sum("estimated_clv").alias("total_clv"))
    everything = F.sum("total_clv").over(Window.partitionBy())
    share = F.col("total_clv") / F.nullif(everything, F.lit(0.0)) * 100
    return per_tier.withColumn("pct_revenue", half_even(share, 1)).orderBy("clv_segment")


def city_npa_rate(customers: DataFrame, k: int = 7) -> DataFrame:
    """Cities with the highest defaulted share of exposure."""
    npa = sum_where(F.col("defaulted") == 1, F.col("loan_amount"))
    rate = npa / F.greatest(F.sum("loan_amount"), F.lit(1.0)) * 100
    return (customers.where(F.col("has_loan") == 1).groupBy("city")
            .agg(half_even(rate, 2).alias("npa_rate"))
            .orderBy(F.desc("npa_rate"), "city").limit(k))


def city_npa_exposure(customers: DataFrame) -> DataFrame:
    """All cities by defaulted exposure, the rate to one digit."""
    npa = sum_where(F.col("defaulted") == 1, F.col("loan_amount"))
    rate = npa / F.greatest(F.sum("loan_amount"), F.lit(1.0)) * 100
    loans = customers.where(F.col("has_loan") == 1) if "has_loan" in customers.columns else customers
    return (loans.groupBy("city")
            .agg(npa.alias("npa_exposure"), half_even(rate, 1).alias("npa_rate"))
            .orderBy(F.desc("npa_exposure"), "city"))


def high_risk_table(book: DataFrame, k: int = 20, columns: list[str] | None = None) -> DataFrame:
    """Top-tier customers by probability; missing numbers show as zero."""
    shown = columns or ["customer_id", "city", "credit_score", "income", "loan_amount",
                        "default_probability", "risk_tier"]
    picked = book.where(F.col("risk_tier") == "High Risk")
    return select_present(top_k(picked, "default_probability", k), shown).na.fill(0)


def drill_down(book: DataFrame, n: int = 200) -> DataFrame:
    """First customers with segment names and display text."""
    shown = ["customer_id", "city", "employment_type", "credit_score", "income", "loan_amount",
             "default_probability", "risk_tier", "estimated_clv", "clv_segment", "segment"]
    page = select_present(book, shown).orderBy("customer_id").limit(n)
    dressed = {"segment": segment_name(F.col("segment")),
               "default_probability": as_percent(F.col("default_probability")),
               "estimated_clv": as_rupees(F.col("estimated_clv"))}
    return page.withColumns({c: x for c, x in dressed.items() if c in page.columns})


def as_document(report: DataFrame, name: str) -> DataFrame:
    """A bounded report as one JSON document, for a client to fetch."""
    row = F.struct(*[F.col(c) for c in report.columns])
    packed = report.agg(F.collect_list(row).alias("rows"))
    return packed.select(F.lit(name).alias("name"), F.to_json("rows").alias("document"))
