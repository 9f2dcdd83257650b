"""Monthly revenue series and forecasts, for one series or for many at once."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.columns import month_of

# Revenue per unit moved, and the 5 % point of the Dickey-Fuller test with a constant.
CREDIT_MARGIN = 0.015
DEBIT_MARGIN = 0.005
DF_CRITICAL = -2.9
Z95 = 1.96


def revenue_proxy() -> Column:
    margin = F.when(F.col("transaction_type") == "Credit", F.lit(CREDIT_MARGIN)).otherwise(F.lit(DEBIT_MARGIN))
    return F.col("amount") * margin


def monthly_revenue(transactions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue per month (and per ``by`` key); months without movements have no row."""
    return (transactions.groupBy(*by, month_of(F.col("transaction_date")).alias("month"))
            .agg(F.sum(revenue_proxy()).alias("revenue")).orderBy(*by, "month"))


def _by_month(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy("month")


def dickey_fuller(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Dickey-Fuller t statistic per series and the differencing order it suggests.

    Regresses the change on the previous level with a constant.
    """
    level = F.lag("revenue").over(_by_month(by))
    steps = monthly.select(*by, level.alias("x"), (F.col("revenue") - level).alias("dy"))
    # The first month has no step: the regression aggregates skip it.
    stats = steps.groupBy(*by).agg(
        F.count("x").alias("n"), F.regr_slope("dy", "x").alias("slope"),
        F.regr_sxx("dy", "x").alias("sxx"), F.regr_syy("dy", "x").alias("syy"))
    residual = (F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx")) / (F.col("n") - 2)
    error = F.sqrt(F.greatest(residual, F.lit(0.0)) / F.col("sxx"))
    t = F.when((F.col("n") > 2) & (F.col("sxx") > 0) & (error > 0), F.col("slope") / error)
    return stats.select(*by, F.col("n").alias("observations"), "slope", t.alias("t_stat"),
                        F.when(t < DF_CRITICAL, F.lit(0)).otherwise(F.lit(1)).alias("d"))


def forecast_calendar(monthly: DataFrame, steps: int = 12, by: Sequence[str] = ()) -> DataFrame:
    """The ``steps`` months after the last one of each series, numbered from 1."""
    last = monthly.groupBy(*by).agg(F.max("month").alias("last"))
    return last.select(*by, F.posexplode(F.sequence(
        F.add_months("last", 1), F.add_months("last", steps), F.expr("interval 1 month"))).alias("p", "month")
    ).select(*by, (F.col("p") + 1).alias("step"), F.col("month").cast("date").alias("month"))


def with_history(monthly: DataFrame, forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """History and forecast in one table; history has no bounds."""
    history = monthly.select(*by, "month", "revenue", F.lit(None).cast("double").alias("lower_95"),
                             F.lit(None).cast("double").alias("upper_95"), F.lit("historical").alias("type"))
    ahead = forecast.select(*by, "month", "revenue", "lower_95", "upper_95", F.lit("forecast").alias("type"))
    return history.unionByName(ahead)


def seasonal_forecast(monthly: DataFrame, steps: int = 12, by: Sequence[str] = ()) -> DataFrame:
    """Linear trend times a month-of-year factor, all with built-in aggregates.

    The band is 1.96 deviations of the in-sample error.  A series is as long as
    its months, so the per-series window stays small.
    """
    t = F.row_number().over(_by_month(by)).cast("double")
    timed = monthly.select(*by, "month", F.col("revenue").alias("y"), t.alias("t"))
    trend = timed.groupBy(*by).agg(F.regr_slope("y", "t").alias("slope"),
                                   F.regr_intercept("y", "t").alias("level"), F.max("t").alias("size"))
    line = F.col("level") + F.col("slope") * F.col("t")
    fitted = _join_series(timed, trend, by).withColumn("line", line)
    season = fitted.groupBy(*by, F.month("month").alias("moy")).agg(
        F.avg(F.col("y") / F.nullif("line", F.lit(0.0))).alias("factor"))
    scored = fitted.withColumn("moy", F.month("month")).join(season, [*by, "moy"])
    spread = scored.groupBy(*by).agg(
        F.coalesce(F.stddev_samp(F.col("y") - F.col("line") * F.col("factor")), F.lit(0.0)).alias("sd"))
    calendar = forecast_calendar(monthly, steps, by).withColumn("moy", F.month("month"))
    ahead = _join_series(_join_series(calendar, trend, by), spread, by)
    # A month of the year never seen keeps the plain trend.
    ahead = ahead.join(season, [*by, "moy"], "left")
    value = (F.col("level") + F.col("slope") * (F.col("size") + F.col("step"))) * F.coalesce("factor", F.lit(1.0))
    return ahead.select(*by, "month", value.alias("revenue"),
                        (value - Z95 * F.col("sd")).alias("lower_95"),
                        (value + Z95 * F.col("sd")).alias("upper_95"))


def _join_series(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach per-series parameters; those of a single unnamed series are a scalar subquery."""
    if by:
        return left.join(right, list(by))
    one = right.select(F.struct(*right.columns).alias("one")).scalar()
    return left.withColumns({c: one[c] for c in right.columns})


# -- ARIMA --------------------------------------------------------------------

def _lagged(y: np.ndarray, lags: int) -> np.ndarray:
    """Rows ``[y[t-1], .., y[t-lags]]`` for t = lags .. n-1."""
    return np.column_stack([y[lags - i: len(y) - i] for i in range(1, lags + 1)])


FITTED, TOO_SHORT, NOT_IDENTIFIED = "fitted", "too short", "not identified"


def _two_stage(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float] | str:
    """Constant, two autoregressive and two moving-average coefficients, the shocks and their deviation; or a status."""
    n = len(w)
    long = max(2, min(int(np.ceil(np.sqrt(max(n, 1)))), n // 4))
    first = long + 2
    if n - first < 5 or n - long < long + 1:
        return TOO_SHORT
    design = np.column_stack([np.ones(n - long), _lagged(w, long)])
    shocks = np.zeros(n)
    shocks[long:] = w[long:] - design @ np.linalg.lstsq(design, w[long:], rcond=None)[0]
    inputs = np.column_stack([np.ones(n - first), w[first - 1:-1], w[first - 2:-2],
                              shocks[first - 1:-1], shocks[first - 2:-2]])
    # Columns on one scale, so that the rank does not hang on the unit of the series.
    width = np.sqrt((inputs ** 2).sum(axis=0))
    if (width == 0).any() or np.linalg.matrix_rank(inputs / width, tol=1e-9) < 5:
        return NOT_IDENTIFIED
    found = np.linalg.lstsq(inputs, w[first:], rcond=None)[0]
    error = w[first:] - inputs @ found
    return found, shocks, float(np.sqrt(error @ error / max(len(error) - 5, 1)))


def two_stage_coefficients(w: np.ndarray) -> np.ndarray | None:
    """Constant, two autoregressive and two moving-average coefficients of :func:`hannan_rissanen`, if it has any."""
    found = _two_stage(w)
    return None if isinstance(found, str) else found[0]


def hannan_rissanen(y: np.ndarray, d: int, steps: int) -> tuple[np.ndarray, np.ndarray, str]:
    """ARIMA(2, d, 2) by two least-squares stages (Hannan and Rissanen 1982).

    A long autoregression estimates the shocks, a second regression uses
    two lags of the series and of the shocks.  Returns the forecast, its
    standard error, built from the moving-average weights, and a status.  A series with fewer
    rows than parameters, or whose regressors do not tell them apart, has no forecast (NaN):
    no other model takes its place.
    """
    w = np.diff(y) if d else y
    n = len(w)
    fitted = _two_stage(w)
    if isinstance(fitted, str):
        return np.full(steps, np.nan), np.full(steps, np.nan), fitted
    (const, a1, a2, m1, m2), shocks, sigma = fitted
    path, noise = list(w), list(shocks)
    for _ in range(steps):
        path.append(const + a1 * path[-1] + a2 * path[-2] + m1 * noise[-1] + m2 * noise[-2])
        noise.append(0.0)
    mean = np.array(path[n:])
    psi = [1.0, a1 + m1]
    psi.append(a1 * psi[1] + a2 + m2)
    while len(psi) < steps:
        psi.append(a1 * psi[-1] + a2 * psi[-2])
    weights = np.array(psi[:steps])
    if d:
        mean, weights = y[-1] + np.cumsum(mean), np.cumsum(weights)
    return mean, sigma * np.sqrt(np.cumsum(weights**2)), FITTED


def arima_forecast(monthly: DataFrame, steps: int = 12, by: Sequence[str] = ()) -> DataFrame:
    """ARIMA(2, d, 2) forecast per series, d from :func:`dickey_fuller`.

    A group is a single series, at most one row per month, and the fit of one
    series is a few small regressions.
    """
    keyed = _join_series(monthly.select(*by, "month", "revenue"), dickey_fuller(monthly, by).select(*by, "d"), by)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month")
        y = pdf["revenue"].to_numpy(dtype=float)
        mean, error, status = hannan_rissanen(y, int(pdf["d"].iloc[0]), steps)
        return pd.DataFrame({
            **{c: [pdf[c].iloc[0]] * steps for c in by},
            "step": np.arange(1, steps + 1, dtype=np.int32), "revenue": mean,
            "lower_95": mean - Z95 * error, "upper_95": mean + Z95 * error, "status": [status] * steps,
        })

    kinds = dict(monthly.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in by]
                       + ["step int", "revenue double", "lower_95 double", "upper_95 double", "status string"])
    group: Iterable[Column | str] = list(by) or [F.lit(0).alias("__series")]
    fitted = keyed.groupBy(*group).applyInPandas(fit, schema)
    calendar = forecast_calendar(monthly, steps, by)
    # NaN of a series without a forecast becomes NULL.
    values = [F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) for c in ("revenue", "lower_95", "upper_95")]
    return calendar.join(fitted, [*by, "step"]).select(*by, "month", *values, "status")


# The fit travels with its task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
