"""ARIMA(2, d, 2) by exact Gaussian likelihood, one series a group.

The likelihood comes from the Kalman recursion of the three-state form of an ARMA(2, 2), started at its
stationary covariance.  Scale and mean leave the search: both have closed best values given the
four coefficients, the mean by running a series of ones through the same filter.  The coefficients are
searched as partial autocorrelations x / sqrt(1 + x^2), which keeps every trial stationary and
invertible.  The search is a quasi-Newton ascent from the two-stage least-squares fit (and from
white noise), accepts only steps uphill, and evaluates all trial points of a step in one batch of filters.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.operators.forecast import (FITTED, NOT_IDENTIFIED, TOO_SHORT, Z95, _join_series, forecast_calendar,
                                         two_stage_coefficients)
from loanloom.operators.stationarity import augmented_dickey_fuller

#: Fewest differenced values: two more than the parameters.
LEAST_VALUES = 8
#: The search stays within this on every transformed coefficient (a partial autocorrelation of 0.9995).
BOUND = 30.0
ROUNDS = 200


def coefficients(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Autoregressive and moving-average coefficients of rows of four transformed ones."""
    r = x / np.sqrt(1 + x * x)
    return (np.column_stack([r[:, 0] * (1 - r[:, 1]), r[:, 1]]), -np.column_stack([r[:, 2] * (1 - r[:, 3]), r[:, 3]]))


def transformed(phi: Sequence[float], theta: Sequence[float]) -> np.ndarray:
    """The inverse of :func:`coefficients`; what is not stationary or invertible is drawn inside."""
    out = []
    for a, b in (phi, [-t for t in theta]):
        second = float(np.clip(b, -0.95, 0.95))
        first = float(np.clip(a / (1 - second), -0.95, 0.95))
        out += [v / np.sqrt(1 - v * v) for v in (first, second)]
    return np.array(out)


def systems(phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transition, shock covariance and stationary covariance (at unit variance) of each row of coefficients."""
    n = len(phi)
    move = np.zeros((n, 3, 3))
    move[:, 0, 0], move[:, 1, 0], move[:, 0, 1], move[:, 1, 2] = phi[:, 0], phi[:, 1], 1.0, 1.0
    load = np.column_stack([np.ones(n), theta])
    shock = load[:, :, None] * load[:, None, :]
    twofold = np.einsum("nij,nkl->nikjl", move, move).reshape(n, 9, 9)
    start = np.linalg.solve(np.eye(9) - twofold, shock.reshape(n, 9, 1)).reshape(n, 3, 3)
    return move, shock, start


def filtered(w: np.ndarray, phi: np.ndarray, theta: np.ndarray, with_mean: bool) -> dict[str, np.ndarray]:
    """Log-likelihood, mean and variance of the shocks for each row of coefficients, and the last predicted state."""
    move, shock, cover = systems(phi, theta)
    n, size = len(phi), len(w)
    state = np.zeros((n, 3, 2))      # of the series, and of a series of ones
    seen = np.column_stack([w, np.ones(size)])
    log_spread, squares = np.zeros(n), np.zeros((n, 2, 2))
    for t in range(size):
        spread = cover[:, 0, 0]
        miss = seen[t] - state[:, 0]
        log_spread += np.log(spread)
        squares += miss[:, :, None] * miss[:, None, :] / spread[:, None, None]
        gain = (move @ cover[:, :, :1])[:, :, 0] / spread[:, None]
        state = move @ state + gain[:, :, None] * miss[:, None, :]
        cover = move @ cover @ move.transpose(0, 2, 1) + shock - gain[:, :, None] * gain[:, None, :] * spread[:, None, None]
    mean = squares[:, 0, 1] / squares[:, 1, 1] if with_mean else np.zeros(n)
    left = squares[:, 0, 0] - 2 * mean * squares[:, 0, 1] + mean ** 2 * squares[:, 1, 1]
    variance = np.maximum(left, 0) / size
    with np.errstate(divide="ignore"):
        likelihood = -0.5 * size * (np.log(2 * np.pi * variance) + 1) - 0.5 * log_spread
    return {"likelihood": likelihood, "mean": mean, "variance": variance, "state": state[:, :, 0] - mean[:, None] * state[:, :, 1],
            "cover": cover, "move": move, "shock": shock}


def ascend(value_of, x: np.ndarray) -> tuple[np.ndarray, float]:
    """A local maximum of ``value_of`` (a function of rows) within the bounds, never below the start."""
    d = len(x)
    best = float(value_of(x[None])[0])
    steps = 2.0 ** -np.arange(-1.0, 18.0)

    def slope(at):
        width = 1e-5 * np.maximum(1.0, np.abs(at))
        ends = value_of(np.concatenate([at + np.diag(width), at - np.diag(width)]))
        return (ends[:d] - ends[d:]) / (2 * width)

    shape, gradient, fresh = np.eye(d), slope(x), True
    for _ in range(ROUNDS):
        direction = shape @ gradient
        size = np.abs(direction).max()
        if not np.isfinite(size) or size < 1e-10:
            break
        trials = np.clip(x + np.outer(steps / max(1.0, size), direction), -BOUND, BOUND)
        values = value_of(trials)
        at = int(np.nanargmax(values))
        if not values[at] > best + 1e-10 * max(1.0, abs(best)):
            if fresh:
                break
            shape, fresh = np.eye(d), True      # try once more straight uphill
            continue
        moved, found = trials[at] - x, slope(trials[at])
        turned = gradient - found
        x, best, gradient, fresh = trials[at], float(values[at]), found, False
        along = moved @ turned
        if along > 1e-12:
            side = np.eye(d) - np.outer(moved, turned) / along
            shape = side @ shape @ side.T + np.outer(moved, moved) / along
    return x, best


def fit_exact(y: np.ndarray, d: int) -> tuple[dict | None, str]:
    """The maximum of the exact likelihood of ARIMA(2, d, 2), with a mean where d is 0; and a status.

    The result holds ``likelihood``, that of the two-stage start (``started``), coefficients, mean, variance and the
    state after the last value.  A series whose differences do not vary has no fit.
    """
    w = np.diff(y) if d else np.asarray(y, dtype=float)
    if len(w) < LEAST_VALUES:
        return None, TOO_SHORT
    scale = float(np.std(w))
    if not np.isfinite(scale) or scale <= 1e-12 * max(1.0, float(np.abs(w).max())):
        return None, NOT_IDENTIFIED
    centre = 0.0 if d else float(w.mean())
    unit = (w - centre) / scale

    def likelihood(rows):
        found = filtered(unit, *coefficients(rows), with_mean=not d)["likelihood"]
        return np.where(np.isfinite(found), found, -np.inf)

    starts = [np.zeros(4), transformed((0.3, 0.0), (0.2, 0.0)), transformed((0.5, -0.3), (-0.4, 0.2))]
    two_stage = two_stage_coefficients(unit)
    if two_stage is not None:
        starts.insert(0, transformed(two_stage[1:3], two_stage[3:5]))
    starts = np.array(starts)
    values = likelihood(starts)
    first = 0
    best = max((ascend(likelihood, starts[i]) for i in sorted({first, int(values.argmax())})), key=lambda r: r[1])
    phi, theta = coefficients(best[0][None])
    found = {k: v[0] for k, v in filtered(unit, phi, theta, with_mean=not d).items()}
    shift = len(w) * np.log(scale)
    return {"phi": phi[0], "theta": theta[0], "mean": centre + scale * found["mean"], "variance": found["variance"] * scale ** 2,
            "likelihood": best[1] - shift, "started": float(values[first]) - shift, "state": found["state"] * scale,
            "cover": found["cover"], "move": found["move"], "shock": found["shock"], "last": float(y[-1])}, FITTED


def ahead(fit: dict, d: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts and their standard errors; with d = 1 the level is a fourth state that adds up the differences."""
    move, shock = np.zeros((4, 4)), np.zeros((4, 4))
    move[:3, :3], shock[:3, :3] = fit["move"], fit["shock"]
    move[3, 3], move[3, 0] = float(d), 1.0
    state, cover = np.append(fit["state"], fit["last"] if d else 0.0), np.zeros((4, 4))
    cover[:3, :3] = fit["cover"]
    out, spread = [], []
    for _ in range(steps):
        state, cover = move @ state, move @ cover @ move.T + shock
        out.append(state[3] + (0.0 if d else fit["mean"]))
        spread.append(cover[3, 3])
    return np.array(out), np.sqrt(np.maximum(np.array(spread) * fit["variance"], 0.0))


def arima_exact(monthly: DataFrame, steps: int = 12, by: Sequence[str] = ()) -> DataFrame:
    """ARIMA(2, d, 2) forecast of each series by exact likelihood, d from the augmented Dickey-Fuller test.

    NULL and NaN values are left out, as in the test.  Beside value and 95 % band each row has the order
    ``d``, the log-likelihood, that of the start, and a status; a series without a fit has NULL values.
    """
    known = monthly.where(F.col("revenue").isNotNull() & ~F.isnan("revenue")).select(*by, "month", F.col("revenue").cast("double").alias("revenue"))
    keyed = _join_series(known, augmented_dickey_fuller(known, by).select(*by, "d"), by)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["month", "revenue"])
        d = int(pdf["d"].iloc[0])
        found, status = fit_exact(pdf["revenue"].to_numpy(dtype=float), d)
        mean, error = ahead(found, d, steps) if found else (np.full(steps, np.nan), np.full(steps, np.nan))
        return pd.DataFrame({
            **{c: [pdf[c].iloc[0]] * steps for c in by}, "step": np.arange(1, steps + 1, dtype=np.int32), "revenue": mean,
            "lower_95": mean - Z95 * error, "upper_95": mean + Z95 * error, "d": np.full(steps, d, dtype=np.int32),
            "log_likelihood": [found["likelihood"] if found else np.nan] * steps,
            "start_likelihood": [found["started"] if found else np.nan] * steps, "status": [status] * steps})

    kinds = dict(monthly.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in by] + ["step int"] + [f"{c} double" for c in ("revenue", "lower_95", "upper_95")]
                       + ["d int", "log_likelihood double", "start_likelihood double", "status string"])
    fitted = keyed.groupBy(*(list(by) or [F.lit(0).alias("__series")])).applyInPandas(fit, schema)
    numbers = ("revenue", "lower_95", "upper_95", "log_likelihood", "start_likelihood")
    values = [F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) for c in numbers]
    return forecast_calendar(known, steps, by).join(fitted, [*by, "step"]).select(*by, "month", *values[:3], "d", *values[3:], "status")


# The fit travels with its task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
