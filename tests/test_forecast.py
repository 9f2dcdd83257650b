import datetime

import numpy as np
import pytest

from loanloom.operators import forecast


def months(n, year=2018):
    return [datetime.date(year + i // 12, i % 12 + 1, 1) for i in range(n)]


def series(spark, **named):
    rows = [(k, m, float(v)) for k, values in named.items() for m, v in zip(months(len(values)), values)]
    return spark.createDataFrame(rows, "key string, month date, revenue double").repartition(5)


def test_dickey_fuller_matches_least_squares(spark):
    rng = np.random.default_rng(1)
    walk, noise = np.cumsum(rng.normal(size=60)), rng.normal(size=60)
    got = {r["key"]: r for r in forecast.dickey_fuller(series(spark, walk=walk, noise=noise), ["key"]).collect()}
    for name, y in (("walk", walk), ("noise", noise)):
        x, dy = y[:-1], np.diff(y)
        design = np.column_stack([np.ones(len(x)), x])
        coef, *_ = np.linalg.lstsq(design, dy, rcond=None)
        e = dy - design @ coef
        error = np.sqrt(e @ e / (len(x) - 2) / ((x - x.mean()) @ (x - x.mean())))
        assert got[name]["t_stat"] == pytest.approx(coef[1] / error, rel=1e-9)
    assert (got["walk"]["d"], got["noise"]["d"]) == (1, 0)


def test_seasonal_forecast_recovers_trend_and_season(spark):
    factor = 1 + 0.3 * np.sin(np.arange(12))
    factor /= factor.mean()
    y = [(100 + 2 * (i + 1)) * factor[i % 12] for i in range(96)]
    got = forecast.seasonal_forecast(series(spark, a=y), by=["key"]).orderBy("month").collect()
    truth = [(100 + 2 * (i + 1)) * factor[i % 12] for i in range(96, 108)]
    assert [r["revenue"] for r in got] == pytest.approx(truth, rel=0.03)
    assert got[0]["month"] == datetime.date(2026, 1, 1)
    assert all(r["lower_95"] <= r["revenue"] <= r["upper_95"] for r in got)


def test_short_series_without_every_month(spark):
    got = forecast.seasonal_forecast(series(spark, a=[10.0, 12.0, 14.0]), by=["key"]).orderBy("month").collect()
    assert len(got) == 12 and got[0]["revenue"] == pytest.approx(16.0)


def test_arima_fit_finds_the_autoregression():
    rng = np.random.default_rng(7)
    y = np.zeros(600)
    for t in range(1, 600):
        y[t] = 5 + 0.6 * y[t - 1] + rng.normal()
    mean, error, status = forecast.hannan_rissanen(y, 0, 24)
    assert status == forecast.FITTED
    assert mean[-1] == pytest.approx(5 / 0.4, abs=0.6)
    assert error[0] == pytest.approx(1.0, abs=0.15)
    assert np.all(np.diff(error) >= -1e-9)


def test_arima_says_which_series_it_could_not_fit(spark):
    rng = np.random.default_rng(2)
    df = series(spark, long=50 + rng.normal(size=80), short=[1.0, 2.0, 3.0, 4.0], single=[9.0])
    got = forecast.arima_forecast(df, 6, ["key"]).collect()
    assert len(got) == 18
    for r in got:
        fitted = r["key"] == "long"
        assert (r["status"] == forecast.FITTED) is fitted and (r["revenue"] is not None) is fitted and (r["upper_95"] is not None) is fitted


@pytest.mark.parametrize("d", [0, 1])
def test_arima_is_one_model_at_every_length(d):
    rng = np.random.default_rng(4)
    y = 100 + np.cumsum(rng.normal(size=41))
    known = [forecast.hannan_rissanen(y[:n], d, 3) for n in range(3, 41)]
    states = [s for *_, s in known]
    assert states == sorted(states, key=lambda s: s == forecast.FITTED) and states[0] == forecast.TOO_SHORT and states[-1] == forecast.FITTED
    assert states.count(forecast.FITTED) > 25
    assert all(np.isfinite(m).all() == (s == forecast.FITTED) for m, _, s in known)
    assert forecast.hannan_rissanen(np.full(30, 7.0), 0, 3)[2] == forecast.NOT_IDENTIFIED


def test_single_series_and_history(spark):
    monthly = series(spark, a=50 + np.arange(40.0) + np.random.default_rng(3).normal(size=40)).drop("key")
    ahead = forecast.arima_forecast(monthly, 12)
    combined = forecast.with_history(monthly, ahead)
    assert combined.columns == ["month", "revenue", "lower_95", "upper_95", "type"]
    counts = {r[0]: r[1] for r in combined.groupBy("type").count().collect()}
    assert counts == {"historical": 40, "forecast": 12}
    assert combined.where("type = 'historical' and lower_95 is not null").count() == 0


def test_revenue_proxy(spark):
    df = spark.createDataFrame(
        [(datetime.date(2024, 1, 5), 100.0, "Credit"), (datetime.date(2024, 1, 31), 100.0, "Debit"),
         (datetime.date(2024, 3, 1), 10.0, "Debit")], "transaction_date date, amount double, transaction_type string")
    got = [tuple(r) for r in forecast.monthly_revenue(df).collect()]
    assert got == [(datetime.date(2024, 1, 1), pytest.approx(2.0)), (datetime.date(2024, 3, 1), pytest.approx(0.05))]
