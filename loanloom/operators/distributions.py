"""Histograms, quartile boxes, quadrants, counts and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.columns import clip, stable_hash
from loanloom.operators.ordered import exact_quantiles, has_value, quantile_values


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are kept; NULL and NaN are left out.

    A constant column is widened by one half on either side.
    """
    present = df.where(has_value(df, value))
    low, high = present.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    place = F.floor((F.col(value) - F.lit(low)) / F.lit(high - low) * bins)
    counts = (present.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
                     .agg(F.count(F.lit(1)).alias("n")))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + F.lit((high - low) / bins) * (F.col("bin") + 0.5)).alias("midpoint"),
        F.coalesce("n", F.lit(0)).alias("n"))


def winsorised_histogram(df: DataFrame, value: str, bins: int = 40, upper: float = 0.99) -> DataFrame:
    """Histogram after capping the values at an upper quantile."""
    cap = quantile_values(df, value, [upper])[0]
    capped = df.select(clip(F.col(value), high=cap).alias(value))
    return histogram(capped, value, bins)


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Minimum, quartiles, maximum and count per group: what a box plot draws."""
    present = df.where(has_value(df, value) & F.col(group).isNotNull())
    quartiles = exact_quantiles(present, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[group])
    ends = present.groupBy(group).agg(F.min(value).alias("min"), F.max(value).alias("max"),
                                      F.count(F.lit(1)).alias("n"))
    return ends.join(quartiles, group).select(group, "n", "min", "q1", "median", "q3", "max")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is not counted."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


QUADRANTS = ["Stars", "Watch", "Safe", "Default"]


def risk_value_quadrant(probability: Column, value: Column, middle: float, threshold: float = 0.40) -> Column:
    """Quadrant of the risk-against-value plane, split at a probability and the median value."""
    risky, rich = probability >= threshold, value >= middle
    return F.when(probability.isNotNull() & value.isNotNull(),
                  F.when(~risky & rich, "Stars").when(risky & rich, "Watch")
                   .when(~risky & ~rich, "Safe").otherwise("Default"))


def quadrant_counts(df: DataFrame) -> DataFrame:
    middle = quantile_values(df, "estimated_clv", [0.5])[0]
    quadrant = risk_value_quadrant(F.col("default_probability"), F.col("estimated_clv"), middle)
    return (df.withColumn("quadrant", quadrant).where(F.col("quadrant").isNotNull())
              .groupBy("quadrant").agg(F.count(F.lit(1)).alias("n"),
                                       F.sum("estimated_clv").alias("total_clv"),
                                       F.avg("default_probability").alias("avg_pd")))


# -- top rows and samples -----------------------------------------------------

def top_k(df: DataFrame, by: str, k: int, key: str = "customer_id") -> DataFrame:
    """The ``k`` largest rows; the key settles ties so that reruns agree."""
    return df.orderBy(F.desc_nulls_last(by), key).limit(k)


def preview(df: DataFrame, n: int, key: str = "customer_id") -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, n: int, key: str = "customer_id", seed: int = 42) -> DataFrame:
    """Uniform sample of ``n`` rows, the same on every run and partitioning."""
    return (df.withColumn("__hash", stable_hash(F.col(key), seed))
              .orderBy("__hash", key).limit(n).drop("__hash"))


def sample_per_group(df: DataFrame, group: Sequence[str], n: int, key: str = "customer_id", seed: int = 42,
                     salts: int = 64) -> DataFrame:
    """Uniform sample of up to ``n`` rows per group.

    Each of the ``salts`` slices of a group keeps its own ``n`` best hashes first, so
    the second ranking sees at most ``salts * n`` rows of a group of any size.
    """
    hashed = df.withColumn("__hash", stable_hash(F.col(key), seed))
    salted = hashed.withColumn("__salt", F.pmod(F.col("__hash"), F.lit(salts)))
    for partition in ([*group, "__salt"], list(group)):
        ranked = Window.partitionBy(*partition).orderBy("__hash", key)
        salted = salted.withColumn("__rank", F.row_number().over(ranked)).where(F.col("__rank") <= n)
    return salted.drop("__hash", "__salt", "__rank")
