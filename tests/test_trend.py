import datetime

import numpy as np
import pytest
from test_forecast import months, series

from loanloom.operators import trend
from loanloom.operators.forecast import FITTED, NOT_IDENTIFIED, TOO_SHORT


def waved(n, slopes, noise=0.0, seed=0):
    """A trend with a break at 40 % of the history, times a yearly wave."""
    t = np.arange(n)
    line = 100 + slopes[0] * t + (slopes[1] - slopes[0]) * np.maximum(0, t - int(n * 0.4))
    days = np.array([(m - datetime.date(1970, 1, 1)).days for m in months(n)])
    wave = 1 + 0.2 * np.sin(2 * np.pi * days / 365.25) - 0.1 * np.cos(4 * np.pi * days / 365.25)
    return line * wave * (1 + noise * np.random.default_rng(seed).normal(size=n))


def test_sparse_solution_meets_its_conditions():
    draw = np.random.default_rng(1)
    for _ in range(10):
        x, y = draw.normal(size=(40, 12)), draw.normal(size=40)
        x[:, 3] = x[:, 2] + 0.01 * x[:, 3]
        gram, target, penalty = x.T @ x, x.T @ y, 6.0
        b = trend.sparse_solution(gram, target, penalty, np.zeros(12))
        pull = target - gram @ b
        assert (np.abs(pull) <= penalty + 1e-6).all() and (b == 0).any()
        assert pull[b != 0] == pytest.approx(penalty * np.sign(b[b != 0]), abs=1e-6)
    assert (trend.sparse_solution(gram, target, 1e9, np.zeros(12)) == 0).all()


def test_a_planted_break_is_found(spark):
    # Growth stops and turns; the months after it are forecast by the new growth.
    df = series(spark, turn=waved(120, (2.0, -0.5), 0.005), straight=waved(120, (1.0, 1.0), 0.005, seed=4))
    fits = trend.trend_fits(df, ["key"]).cache()
    changes = trend.trend_changes(fits, ["key"]).collect()
    turning = [(r["month"], r["growth_change"]) for r in changes if r["key"] == "turn"]
    largest = min(turning, key=lambda r: r[1])
    assert abs((largest[0] - months(120)[48]).days) < 200 and sum(g for _, g in turning) == pytest.approx(12 * -2.5, rel=0.15)
    assert sum(abs(r["growth_change"]) for r in changes if r["key"] == "straight") < 4
    ahead = trend.trend_forecast(df, 12, ["key"], fits).orderBy("key", "month").collect()
    for key, slopes in (("straight", (1.0, 1.0)), ("turn", (2.0, -0.5))):
        n = 132
        t = np.arange(n)
        line = 100 + slopes[0] * t + (slopes[1] - slopes[0]) * np.maximum(0, t - 48)
        days = np.array([(m - datetime.date(1970, 1, 1)).days for m in months(n)])
        truth = (line * (1 + 0.2 * np.sin(2 * np.pi * days / 365.25) - 0.1 * np.cos(4 * np.pi * days / 365.25)))[120:]
        got = [r for r in ahead if r["key"] == key]
        assert [r["revenue"] for r in got] == pytest.approx(truth, rel=0.05)
        widths = [r["upper_95"] - r["lower_95"] for r in got]
        assert all(w > 0 for w in widths) and all(r["lower_95"] < r["revenue"] < r["upper_95"] for r in got)


def test_every_fit_is_an_optimum(spark):
    draw = np.random.default_rng(7)
    named = {f"s{i}": 50 + np.cumsum(draw.normal(size=60 + 7 * i)) + 5 * np.sin(np.arange(60 + 7 * i) * 2 * np.pi / 12) for i in range(5)}
    named |= {"wave": waved(90, (1.0, 0.0), 0.02), "minus": -waved(90, (0.5, 1.0), 0.02), "exact": waved(72, (1.0, 1.0))}
    df = series(spark, **named)
    rows = trend.trend_optimality(df, ["key"]).collect()
    assert {r["key"]: r["violations"] for r in rows} == dict.fromkeys(named, 0)
    # A fit moved off its optimum is told apart.
    moved = trend.trend_fits(df, ["key"]).selectExpr("* except (slope)", "slope + 0.01 as slope")
    assert all(r["violations"] > 0 for r in trend.trend_optimality(df, ["key"], moved).collect())


def test_statuses_and_a_single_series(spark):
    df = series(spark, short=[1.0] * 11, zero=[0.0] * 30, flat=[7.0] * 30)
    found = {r["key"]: r["status"] for r in trend.trend_fits(df, ["key"]).collect()}
    assert found == {"short": TOO_SHORT, "zero": NOT_IDENTIFIED, "flat": FITTED}
    ahead = trend.trend_forecast(df, 3, ["key"]).collect()
    assert len(ahead) == 9 and {r["revenue"] is not None for r in ahead if r["key"] != "flat"} == {False}
    assert all(r["revenue"] == pytest.approx(7.0, rel=1e-3) for r in ahead if r["key"] == "flat")
    one = df.where("key = 'flat'").drop("key")
    assert trend.trend_forecast(one, 3).count() == 3
    assert trend.trend_fits(df.limit(0), ["key"]).collect() == []


def test_missing_values_are_left_out(spark):
    y = waved(48, (1.0, 1.0), 0.01)
    whole = series(spark, a=y)
    broken = whole.union(spark.createDataFrame([("a", datetime.date(2021, 1, 15), None), ("a", datetime.date(2021, 1, 16), float("nan"))], whole.schema))
    assert trend.trend_fits(whole, ["key"]).first() == trend.trend_fits(broken, ["key"]).first()
