import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_forecast import series

from loanloom.operators import stationarity


def by_least_squares(y):
    """(lag, t) by one regression for each lag count."""
    y = np.asarray(y, dtype=float) - np.mean(y)     # as given, a large level costs the comparison its digits
    n, dy = len(y), np.diff(y)
    most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)

    def regress(lag, first):
        rows = range(first, len(dy))
        x = np.array([[1.0, y[t], *[dy[t - i] for i in range(1, lag + 1)]] for t in rows])
        target = dy[first:]
        beta = np.linalg.lstsq(x, target, rcond=None)[0]
        e = target - x @ beta
        return e @ e, beta, x

    scores = []
    for lag in range(most + 1):
        ssr, _, x = regress(lag, most)
        scores.append((len(x) * math.log(ssr / len(x)) + 2 * (lag + 2), lag))
    lag = min(scores)[1]
    ssr, beta, x = regress(lag, lag)
    cover = np.linalg.inv(x.T @ x) * ssr / (len(x) - x.shape[1])
    return lag, beta[1] / math.sqrt(cover[1, 1])


def test_lag_and_t_equal_separate_regressions(spark):
    draw = np.random.default_rng(11)
    named = {"walk": np.cumsum(draw.normal(size=90)), "noise": 1e6 + draw.normal(size=80), "short": draw.normal(size=9),
             "trend": 5.0 * np.arange(60) + draw.normal(size=60), "tiny": draw.normal(size=4) * 1e-9}
    wave = np.zeros(200)
    for t in range(3, 200):
        wave[t] = 0.5 * wave[t - 1] - 0.4 * wave[t - 3] + draw.normal()
    named["lagged"] = wave
    got = {r["key"]: r for r in stationarity.augmented_dickey_fuller(series(spark, **named), ["key"]).collect()}
    for name, y in named.items():
        lag, t = by_least_squares(y)
        assert (got[name]["lags"], got[name]["observations"]) == (lag, len(y))
        assert got[name]["t_stat"] == pytest.approx(t, rel=1e-6)
        assert got[name]["d"] == (0 if got[name]["p_value"] < 0.05 else 1)
    assert got["lagged"]["lags"] >= 2 and (got["walk"]["d"], got["noise"]["d"], got["lagged"]["d"]) == (1, 0, 0)


def test_series_without_a_regression(spark):
    df = series(spark, flat=[3.0] * 40, three=[1.0, 2.0, 4.0], one=[5.0]).union(
        spark.createDataFrame([("gap", None, None), ("gap", None, float("nan"))], "key string, month date, revenue double"))
    got = {r["key"]: r for r in stationarity.augmented_dickey_fuller(df, ["key"]).collect()}
    assert {k: (r["t_stat"], r["p_value"], r["d"]) for k, r in got.items()} == dict.fromkeys(["flat", "three", "one", "gap"], (None, None, 1))
    assert got["gap"]["observations"] == 0
    assert stationarity.augmented_dickey_fuller(df.limit(0), ["key"]).collect() == []
    assert stationarity.augmented_dickey_fuller(df.limit(0)).first()["d"] == 1


def test_missing_values_are_left_out(spark):
    y = list(np.random.default_rng(4).normal(size=50))
    whole = series(spark, a=y)
    broken = whole.union(spark.createDataFrame([("a", None, None)], whole.schema)).withColumn(
        "month", F.coalesce("month", F.lit("2019-05-15").cast("date")))
    one, two = (stationarity.augmented_dickey_fuller(d, ["key"]).first() for d in (whole, broken))
    assert one == two


def test_distribution_and_surface(spark):
    points = [-11.0, -4.0, -1.959963984540054, -0.3, 0.0, 1.0, 5.0, 9.0]
    rows = spark.createDataFrame([(x,) for x in points], "x double").select("x", stationarity.normal_cdf(F.col("x")).alias("p")).collect()
    for r in rows:
        assert r["p"] == pytest.approx(0.5 * math.erfc(-r["x"] / math.sqrt(2)), abs=1e-14)
    # Published 1, 5 and 10 % points of the test with a constant.
    points = spark.createDataFrame([(-3.43,), (-2.86,), (-2.57,), (-30.0,), (3.0,), (None,)], "t double")
    found = [r[0] for r in points.select(stationarity.surface_p(F.col("t"))).collect()]
    assert found[:3] == pytest.approx([0.01, 0.05, 0.10], abs=0.002) and found[3:] == [0.0, 1.0, None]
