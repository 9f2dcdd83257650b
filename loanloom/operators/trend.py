"""Forecast by a piecewise linear trend times a yearly wave, for many series at once.

    value = scale * (level + slope t + sum of change_j * max(0, t - place_j)) * (1 + sum of wave_k * Fourier_k(day of year))

with t from 0 to 1 over the history.  Possible changes lie evenly over the first part of it; their sum of absolute
values is penalised, so that most are exactly zero, and the waves have a weak quadratic penalty.  Given the waves
the trend is a sparse regression (coordinate descent on a Gram matrix, level and slope eliminated first), given the trend the
waves are a small linear system; the two alternate to a point that is optimal in each.  The fit of a series, a few dozen months,
is one row; forecasts, found changes and the check of optimality are expressions over these rows.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.forecast import FITTED, NOT_IDENTIFIED, TOO_SHORT, Z95, forecast_calendar

# Number of possible changes, the part of the history they lie in, scales of the priors.
CHANGES, CHANGE_RANGE = 25, 0.8
CHANGE_SCALE, WAVE_SCALE = 0.05, 10.0
YEAR_DAYS = 365.25
#: Harmonics of the year; months tell no more apart.
HARMONICS = 5
LEAST_MONTHS = 12
_LEAST_NOISE = 1e-6
_EPOCH = "1970-01-01"

FIT_COLUMNS = ("months int, first_day int, span_days int, scale double, level double, slope double, places array<double>, "
               "changes array<double>, waves array<double>, noise double, status string")


def change_places(t: np.ndarray) -> np.ndarray:
    """Possible changes at observed times, evenly by rank over the first part of the history."""
    early = int(np.floor(len(t) * CHANGE_RANGE))
    count = min(CHANGES, early - 1)
    return np.unique(t[np.linspace(0, early - 1, count + 1).round().astype(int)[1:]]) if count > 0 else np.zeros(0)


def wave_columns(days: np.ndarray) -> np.ndarray:
    angle = 2 * np.pi * np.outer(days, np.arange(1, HARMONICS + 1)) / YEAR_DAYS
    return np.column_stack([np.sin(angle), np.cos(angle)])


def sparse_solution(gram: np.ndarray, target: np.ndarray, penalty: float, start: np.ndarray, sweeps: int = 2000) -> np.ndarray:
    """Minimum of b'Gb/2 - c'b + penalty * sum |b| by coordinate descent, polished on the coordinates left nonzero."""
    b = start.copy()
    usable = np.flatnonzero(np.diag(gram) > 1e-12 * max(1.0, float(np.diag(gram).max(initial=0.0))))
    for _ in range(sweeps):
        most = 0.0
        for j in usable:
            pull = target[j] - gram[j] @ b + gram[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / gram[j, j]
            most = max(most, abs(new - b[j]))
            b[j] = new
        if most < 1e-10:
            break
    held = np.flatnonzero(b)
    if len(held):
        try:
            exact = np.linalg.solve(gram[np.ix_(held, held)], target[held] - penalty * np.sign(b[held]))
        except np.linalg.LinAlgError:
            return b
        polished = np.zeros_like(b)
        polished[held] = exact
        if (np.sign(exact) == np.sign(b[held])).all() and (np.abs(target - gram @ polished) <= penalty * (1 + 1e-9) + 1e-12).all():
            return polished
    return b


def fit_trend(days: np.ndarray, y: np.ndarray) -> dict:
    """The fit of one series in order of its days; keys as in ``FIT_COLUMNS``."""
    out = {"months": len(y), "first_day": int(days[0]) if len(y) else 0, "span_days": int(days[-1] - days[0]) if len(y) else 0, "scale": None,
           "level": None, "slope": None, "places": None, "changes": None, "waves": None, "noise": None, "status": TOO_SHORT}
    if len(y) < LEAST_MONTHS or days[-1] == days[0]:
        return out
    scale = float(np.abs(y).max())
    if not scale > 0:
        return {**out, "status": NOT_IDENTIFIED}
    unit, t = y / scale, (days - days[0]) / (days[-1] - days[0])
    places = change_places(t)
    hinges, waves = np.maximum(0.0, t[:, None] - places), wave_columns(days)
    change, wave, season = np.zeros(len(places)), np.zeros(waves.shape[1]), np.zeros(len(y))
    noise = float(np.var(unit)) + _LEAST_NOISE
    line = np.zeros(2)
    for turn in range(400):
        before = np.concatenate([line, change, wave])
        # Trend: columns times the season; level and slope are free, so they are projected out first.
        by = (1 + season)[:, None]
        plain, bent = by * np.column_stack([np.ones(len(t)), t]), by * hinges
        basis, _ = np.linalg.qr(plain)
        clear, target = bent - basis @ (basis.T @ bent), unit - basis @ (basis.T @ unit)
        change = sparse_solution(clear.T @ clear, clear.T @ target, noise / CHANGE_SCALE, change)
        line = np.linalg.lstsq(plain, unit - bent @ change, rcond=None)[0]
        trend = line[0] + line[1] * t + hinges @ change
        # Waves: columns times the trend, with a quadratic penalty.
        moved = trend[:, None] * waves
        wave = np.linalg.solve(moved.T @ moved + noise / WAVE_SCALE ** 2 * np.eye(waves.shape[1]), moved.T @ (unit - trend))
        season = waves @ wave
        if turn < 20:
            noise = max(float(np.mean((unit - trend * (1 + season)) ** 2)), _LEAST_NOISE)
        elif np.abs(np.concatenate([line, change, wave]) - before).max() < 1e-11:
            break
    return {**out, "scale": scale, "level": float(line[0]), "slope": float(line[1]), "places": places.tolist(), "changes": change.tolist(),
            "waves": wave.tolist(), "noise": noise, "status": FITTED}


def trend_fits(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per series: the fitted trend, changes and waves.  NULL and NaN values are left out."""
    known = monthly.where(F.col("revenue").isNotNull() & ~F.isnan("revenue")).select(
        *by, F.datediff("month", F.lit(_EPOCH).cast("date")).alias("day"), F.col("revenue").cast("double").alias("y"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["day", "y"])
        found = fit_trend(pdf["day"].to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float))
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in by}, **{k: [v] for k, v in found.items()}})

    kinds = dict(monthly.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in by] + [FIT_COLUMNS])
    return known.groupBy(*(list(by) or [F.lit(0).alias("__series")])).applyInPandas(fit, schema)


def _place(day: Column) -> Column:
    return (day - F.col("first_day")) / F.col("span_days")


def _trend(t: Column) -> Column:
    bends = F.zip_with("places", "changes", lambda p, c: c * F.greatest(F.lit(0.0), t - p))
    return F.col("level") + F.col("slope") * t + F.aggregate(bends, F.lit(0.0), lambda a, v: a + v)


def _wave_values(day: Column) -> Column:
    angles = [F.lit(2 * float(np.pi) * k / YEAR_DAYS) * day for k in range(1, HARMONICS + 1)]
    return F.array(*[F.sin(a) for a in angles], *[F.cos(a) for a in angles])


def _season(day: Column) -> Column:
    return F.aggregate(F.zip_with(_wave_values(day), "waves", lambda f, w: f * w), F.lit(0.0), lambda a, v: a + v)


def _of_series(rows: DataFrame, fits: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the fit of their series; a single series has one row of fits."""
    if by:
        return rows.join(fits, list(by))
    one = fits.select(F.struct(*fits.columns).alias("one")).scalar()
    return rows.withColumns({c: one[c] for c in fits.columns})


def trend_forecast(monthly: DataFrame, steps: int = 12, by: Sequence[str] = (), fits: DataFrame | None = None) -> DataFrame:
    """The next ``steps`` months of each series with a 95 % band and a status.

    The band holds the noise and the changes still to come: as many a year as the history could have had, of the mean size of
    the fitted ones.  A series without a fit has NULL values.
    """
    fits = trend_fits(monthly, by) if fits is None else fits
    known = monthly.where(F.col("revenue").isNotNull() & ~F.isnan("revenue"))
    rows = _of_series(forecast_calendar(known, steps, by), fits, by)
    rows = rows.withColumn("day", F.datediff("month", F.lit(_EPOCH).cast("date"))).withColumn("t", _place(F.col("day")))
    rows = rows.withColumns({"trend": _trend(F.col("t")), "season": 1 + _season(F.col("day"))})
    count = F.size("changes")
    mean_size = F.when(count > 0, F.aggregate("changes", F.lit(0.0), lambda a, v: a + F.abs(v)) / count).otherwise(0.0)
    coming = count / CHANGE_RANGE * 2 * mean_size * mean_size * F.pow(F.col("t") - 1, F.lit(3.0)) / 3
    width = Z95 * F.sqrt(F.col("noise") + coming * F.col("season") * F.col("season")) * F.col("scale")
    value = F.col("scale") * F.col("trend") * F.col("season")
    return rows.select(*by, "month", value.alias("revenue"), (value - width).alias("lower_95"), (value + width).alias("upper_95"), "status")


def trend_changes(fits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The changes that the fit keeps: their month and how much the yearly growth changes there."""
    found = fits.select(*by, "first_day", "span_days", "scale", F.inline(F.arrays_zip("places", "changes"))).where("changes <> 0")
    day = F.round(F.col("first_day") + F.col("places") * F.col("span_days")).cast("int")
    return found.select(*by, F.date_add(F.lit(_EPOCH).cast("date"), day).alias("month"),
                        (F.col("changes") * F.col("scale") * YEAR_DAYS / F.col("span_days")).alias("growth_change"))


def trend_optimality(monthly: DataFrame, by: Sequence[str] = (), fits: DataFrame | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Per series: how many coefficients it has, and how many break the conditions of an optimum.

    At an optimum the residuals are orthogonal to the columns of level and slope, pull on a kept change with exactly the
    penalty and on a dropped one with no more, and on a wave with its quadratic penalty.
    """
    fits = trend_fits(monthly, by) if fits is None else fits
    known = monthly.where(F.col("revenue").isNotNull() & ~F.isnan("revenue"))
    rows = _of_series(known.select(*by, "month", "revenue"), fits.where(F.col("status") == FITTED), by)
    rows = rows.where("scale is not null").withColumn("day", F.datediff("month", F.lit(_EPOCH).cast("date"))).withColumn("t", _place(F.col("day")))
    rows = rows.withColumns({"trend": _trend(F.col("t")), "season": 1 + _season(F.col("day"))})
    left = F.col("revenue") / F.col("scale") - F.col("trend") * F.col("season")
    bends = F.zip_with("places", "changes", lambda p, c: F.struct(
        F.lit("change").alias("kind"), c.alias("value"), (F.greatest(F.lit(0.0), F.col("t") - p) * F.col("season")).alias("x")))
    waves = F.zip_with(_wave_values(F.col("day")), "waves", lambda f, w: F.struct(F.lit("wave").alias("kind"), w.alias("value"), (f * F.col("trend")).alias("x")))
    lines = F.array(*[F.struct(F.lit("line").alias("kind"), F.lit(0.0).alias("value"), x.alias("x")) for x in (F.col("season"), F.col("t") * F.col("season"))])
    columns = rows.select(*by, "noise", left.alias("left"), F.posexplode(F.concat(lines, bends, waves)).alias("j", "c"))
    pulls = columns.groupBy(*by, "j", F.col("c.kind").alias("kind"), F.col("c.value").alias("value"), "noise").agg(F.sum(F.col("left") * F.col("c.x")).alias("pull"))
    penalty = F.col("noise") / CHANGE_SCALE
    off = (F.when(F.col("kind") == "line", F.abs("pull"))
           .when(F.col("kind") == "wave", F.abs(F.col("pull") - F.col("noise") / WAVE_SCALE ** 2 * F.col("value")))
           .when(F.col("value") != 0, F.abs(F.col("pull") - penalty * F.signum("value")))
           .otherwise(F.greatest(F.lit(0.0), F.abs("pull") - penalty)))
    return pulls.groupBy(*by).agg(F.count("*").alias("coefficients"), F.count_if(off > tolerance).alias("violations"))


# The fit travels with its task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
