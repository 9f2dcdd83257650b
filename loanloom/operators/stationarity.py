"""Augmented Dickey-Fuller test of many series at once, in expressions of the JVM alone.

A series is one row with its values as an array (as long as its months).  With the regressors in the order
constant, level, changes at lag 1, 2, ..., every lag count is a leading part of one design, so a single
elimination of one Gram matrix gives the residual sums of all of them, and the Akaike criterion picks the lag.  The
chosen regression is then run on all months it can use, the level last, so that what elimination leaves is
its slope and error.  The p-value comes from MacKinnon's (1994) response surface.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGNIFICANT = 0.05

# MacKinnon's surface for one series with a constant: its range, where its two branches
# meet, and the polynomials in t of both.
TAU_LEAST, TAU_SPLIT, TAU_MOST = -18.83, -1.61, 2.74
LOW_BRANCH = [2.1659, 1.4412, 0.038269]
HIGH_BRANCH = [1.7339, 0.93202, -0.12745, -0.010368]

#: A pivot below this share of its column's square sum is a column that the earlier ones explain.
_EXPLAINED = 1e-10


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution by its power series, to 1e-15 or so in absolute terms within +-12."""
    x = F.greatest(F.least(x, F.lit(12.0)), F.lit(-12.0))
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(250)), F.struct(x.alias("term"), x.alias("total")),
                        lambda s, k: F.struct((s["term"] * x * x / (2 * k + 1)).alias("term"),
                                              (s["total"] + s["term"] * x * x / (2 * k + 1)).alias("total")))
    return F.greatest(F.least(0.5 + terms["total"] * F.exp(-x * x / 2) / F.lit(2.5066282746310002), F.lit(1.0)), F.lit(0.0))


def surface_p(t: Column) -> Column:
    """p-value of a Dickey-Fuller t with a constant."""
    def polynomial(weights):
        out = F.lit(0.0)
        for w in reversed(weights):
            out = out * t + F.lit(w)
        return out

    return (F.when(t > TAU_MOST, 1.0).when(t < TAU_LEAST, 0.0)
            .when(t <= TAU_SPLIT, normal_cdf(polynomial(LOW_BRANCH))).when(t.isNotNull(), normal_cdf(polynomial(HIGH_BRANCH))))


def gram(rows: Column, width: Column) -> Column:
    """Sums of the products of all pairs of columns over an array of rows."""
    places = F.sequence(F.lit(0), width - 1)
    return F.transform(places, lambda i: F.transform(places, lambda j: F.aggregate(
        rows, F.lit(0.0), lambda total, r: total + F.get(r, i) * F.get(r, j))))


def eliminated(matrix: Column, steps: Column) -> Column:
    """``matrix`` after eliminating its first ``steps`` columns; row p stays as it was when it was the pivot."""
    def step(g, p):
        pivot = F.get(F.get(g, p), p)
        usable = pivot > F.lit(_EXPLAINED) * F.get(F.get(matrix, p), p)
        return F.transform(g, lambda row, i: F.when((i <= p) | ~usable, row).otherwise(F.transform(
            row, lambda v, j: F.when(j <= p, v).otherwise(v - F.get(row, p) * F.get(F.get(g, p), j) / pivot))))

    return F.aggregate(F.sequence(F.lit(0), steps - 1), matrix, step)


def explained(matrix: Column, reduced: Column, steps: Column) -> Column:
    """What each eliminated column takes off the square sum of the last one."""
    last = F.size(matrix) - 1

    def share(p):
        pivot = F.get(F.get(reduced, p), p)
        against = F.get(F.get(reduced, p), last)
        return F.when(pivot > F.lit(_EXPLAINED) * F.get(F.get(matrix, p), p), against * against / pivot).otherwise(0.0)

    return F.transform(F.sequence(F.lit(0), steps - 1), share)


def _changes(lags: Column, at: Column) -> Column:
    """The ``lags`` changes before place ``at``, latest first."""
    return F.when(lags > 0, F.transform(F.sequence(F.lit(1), lags), lambda i: F.get("dz", at - i))).otherwise(F.array().cast("array<double>"))


def most_lags(n: Column) -> Column:
    """Schwert's bound on the lags of a series of n values, within what its length allows."""
    return F.least(F.ceil(12 * F.pow(n / 100, F.lit(0.25))), F.floor(n / 2) - 2).cast("int")


def augmented_dickey_fuller(monthly: DataFrame, by: Sequence[str] = (), value: str = "revenue", order: str = "month") -> DataFrame:
    """Per series: months, lags chosen, t of the level, p-value, and the differencing order (0 if p < 0.05, else 1).

    NULL and NaN values are left out.  A constant series, and one too short for a regression, has no t
    and order 1; a table without rows and without ``by`` is such a series.
    """
    known = F.when(F.col(value).isNotNull() & ~F.isnan(F.col(value)), F.struct(F.col(order), F.col(value).cast("double").alias("y")))
    series = monthly.groupBy(*by).agg(F.array_sort(F.collect_list(known)).alias("points"))
    series = series.select(*by, F.col("points.y").alias("y"), F.size("points").alias("observations"))
    # Centred and scaled: t does not change, and the sums keep their digits.
    mean = F.aggregate("y", F.lit(0.0), lambda a, v: a + v) / F.nullif("observations", F.lit(0))
    series = series.withColumn("mean", mean).withColumn("width", F.array_max(F.transform("y", lambda v: F.abs(v - F.col("mean")))))
    series = series.withColumn("m", F.when((F.col("width") > 0) & (most_lags(F.col("observations")) >= 0), most_lags(F.col("observations"))))
    z = F.transform("y", lambda v: (v - F.col("mean")) / F.col("width"))
    steps = F.transform(F.sequence(F.lit(0), F.col("observations") - 2), lambda t: F.get("z", t + 1) - F.get("z", t))
    usable = F.col("m").isNotNull()
    series = series.withColumn("z", F.when(usable, z)).withColumn("dz", F.when(usable, steps))

    # One design for all lag counts, over the months that the longest can use.
    def design(t):
        return F.concat(F.array(F.lit(1.0), F.get("z", t)), _changes(F.col("m"), t), F.array(F.get("dz", t)))

    rows = F.when(usable, F.transform(F.sequence(F.col("m"), F.col("observations") - 2), design))
    series = series.withColumn("g", F.when(usable, gram(rows, F.col("m") + 3)))
    series = series.withColumn("e", F.when(usable, eliminated(F.col("g"), F.col("m") + 2)))
    series = series.withColumn("taken", F.when(usable, explained(F.col("g"), F.col("e"), F.col("m") + 2)))
    months = (F.col("observations") - 1 - F.col("m")).cast("double")
    square = F.get(F.get("g", F.col("m") + 2), F.col("m") + 2)

    def akaike(lag):
        left = square - F.aggregate(F.slice("taken", F.lit(1), lag + 2), F.lit(0.0), lambda a, v: a + v)
        return F.struct((months * F.ln(F.greatest(left, square * 1e-15) / months) + 2.0 * (lag + 2)).alias("aic"), lag.alias("lag"))

    best = F.array_min(F.transform(F.sequence(F.lit(0), F.col("m")), akaike))["lag"]
    series = series.withColumn("lags", F.when(usable, best))

    # The chosen regression: constant, changes, level, outcome.
    def chosen(t):
        return F.concat(F.array(F.lit(1.0)), _changes(F.col("lags"), t), F.array(F.get("z", t), F.get("dz", t)))

    rows = F.when(usable, F.transform(F.sequence(F.col("lags"), F.col("observations") - 2), chosen))
    series = series.withColumn("g2", F.when(usable, gram(rows, F.col("lags") + 3)))
    series = series.withColumn("e2", F.when(usable, eliminated(F.col("g2"), F.col("lags") + 1)))

    def left_over(i, j):
        return F.get(F.get("e2", F.col("lags") + i), F.col("lags") + j)

    sxx, sxy, syy = left_over(1, 1), left_over(1, 2), left_over(2, 2)
    free = F.col("observations") - 1 - F.col("lags") - (F.col("lags") + 2)
    apart = sxx > F.lit(_EXPLAINED) * F.get(F.get("g2", F.col("lags") + 1), F.col("lags") + 1)
    error = F.sqrt(F.greatest(syy - sxy * sxy / sxx, F.lit(0.0)) / free / sxx)
    t = F.when(usable & apart & (free > 0), F.when(error > 0, sxy / sxx / error))
    series = series.withColumn("t_stat", t).withColumn("p_value", surface_p(F.col("t_stat")))
    return series.select(*by, "observations", "lags", "t_stat", "p_value",
                         F.when(F.col("p_value") < SIGNIFICANT, F.lit(0)).otherwise(F.lit(1)).alias("d"))
