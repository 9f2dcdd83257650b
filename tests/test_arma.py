import numpy as np
import pytest
from test_forecast import series

from loanloom.operators import arma
from loanloom.operators.forecast import FITTED, NOT_IDENTIFIED, TOO_SHORT


def moments(phi, theta, size):
    """Autocovariances at unit shock variance from a long moving-average form."""
    psi = np.zeros(4000)
    psi[0], psi[1] = 1.0, phi[0] + theta[0]
    psi[2] = phi[0] * psi[1] + phi[1] + theta[1]
    for i in range(3, 4000):
        psi[i] = phi[0] * psi[i - 1] + phi[1] * psi[i - 2]
    return np.array([psi[:4000 - k] @ psi[k:] for k in range(size)])


@pytest.mark.parametrize("phi, theta", [((0.5, 0.2), (0.3, -0.1)), ((-0.4, 0.3), (0.0, 0.0)), ((1.2, -0.5), (-0.6, 0.3))])
@pytest.mark.parametrize("with_mean", [False, True])
def test_likelihood_equals_the_dense_density(phi, theta, with_mean):
    w = 3.0 + np.random.default_rng(1).normal(size=12)
    found = arma.filtered(w, np.array([phi]), np.array([theta]), with_mean)
    gamma = moments(phi, theta, 12)
    cover = gamma[np.abs(np.subtract.outer(np.arange(12), np.arange(12)))]
    inverse, ones = np.linalg.inv(cover), np.ones(12)
    mean = ones @ inverse @ w / (ones @ inverse @ ones) if with_mean else 0.0
    variance = (w - mean) @ inverse @ (w - mean) / 12
    density = -0.5 * (12 * np.log(2 * np.pi * variance) + np.linalg.slogdet(cover)[1] + 12)
    assert found["likelihood"][0] == pytest.approx(density, rel=1e-9)
    assert found["mean"][0] == pytest.approx(mean, abs=1e-9) and found["variance"][0] == pytest.approx(variance, rel=1e-9)


def test_forecast_equals_the_conditional_normal():
    y = 10 + np.cumsum(np.random.default_rng(2).normal(size=30))
    for d in (0, 1):
        fit, _ = arma.fit_exact(y, d)
        mean, error = arma.ahead(fit, d, 5)
        w = np.diff(y) if d else y
        n, gamma = len(w), moments(fit["phi"], fit["theta"], len(w) + 5)
        cover = fit["variance"] * gamma[np.abs(np.subtract.outer(np.arange(n + 5), np.arange(n + 5)))]
        weights = cover[n:, :n] @ np.linalg.inv(cover[:n, :n])
        step = fit["mean"] + weights @ (w - fit["mean"])
        left = cover[n:, n:] - weights @ cover[:n, n:]
        total = np.tril(np.ones((5, 5))) if d else np.eye(5)
        assert mean == pytest.approx((y[-1] if d else 0) + total @ step, rel=1e-6)
        assert error == pytest.approx(np.sqrt(np.diag(total @ left @ total.T)), rel=1e-6)


def test_never_below_the_start_and_a_maximum():
    draw = np.random.default_rng(3)
    for _ in range(4):
        phi, theta = (0.6, -0.3), (0.4, 0.2)
        e, w = draw.normal(size=160), np.zeros(160)
        for t in range(2, 160):
            w[t] = phi[0] * w[t - 1] + phi[1] * w[t - 2] + e[t] + theta[0] * e[t - 1] + theta[1] * e[t - 2]
        fit, status = arma.fit_exact(100 + 5 * w, 0)
        assert status == FITTED and fit["likelihood"] >= fit["started"] - 1e-9
        truth = arma.filtered(100 + 5 * w, np.array([phi]), np.array([theta]), True)["likelihood"][0]
        assert fit["likelihood"] >= truth - 1e-6
        near = arma.transformed(fit["phi"], fit["theta"]) + draw.normal(size=(50, 4)) * 0.05
        around = arma.filtered(100 + 5 * w, *arma.coefficients(near), True)["likelihood"]
        assert (around <= fit["likelihood"] + 1e-6).all()


def test_transformation_round_trip():
    x = np.random.default_rng(5).normal(size=(20, 4))
    phi, theta = arma.coefficients(x)
    for a, b, row in zip(phi, theta, x):
        assert arma.transformed(a, b) == pytest.approx(np.clip(row, -3.0424, 3.0424), rel=1e-6)
        assert (np.abs(np.roots([1, -a[0], -a[1]])) < 1).all() and (np.abs(np.roots([1, b[0], b[1]])) < 1).all()


def test_statuses_and_many_series(spark):
    draw = np.random.default_rng(6)
    named = {"walk": 100 + np.cumsum(draw.normal(size=70)), "noise": 50 + draw.normal(size=70), "short": [1.0, 2.0, 3.0], "flat": [4.0] * 30}
    got = arma.arima_exact(series(spark, **named), 6, ["key"]).orderBy("key", "month").collect()
    assert len(got) == 24
    states = {r["key"]: (r["status"], r["d"], r["revenue"] is not None) for r in got}
    assert states == {"walk": (FITTED, 1, True), "noise": (FITTED, 0, True), "short": (TOO_SHORT, 1, False), "flat": (NOT_IDENTIFIED, 1, False)}
    assert all(r["lower_95"] < r["revenue"] < r["upper_95"] for r in got if r["status"] == FITTED)
    alone = arma.arima_exact(series(spark, walk=named["walk"]).drop("key"), 6).orderBy("month").collect()
    assert [r["revenue"] for r in alone] == pytest.approx([r["revenue"] for r in got if r["key"] == "walk"])


def test_scale_does_not_matter():
    y = np.random.default_rng(8).normal(size=60)
    small, large = arma.fit_exact(y, 0)[0], arma.fit_exact(y * 1e6 + 5e6, 0)[0]
    assert large["phi"] == pytest.approx(small["phi"], abs=1e-3)
    assert large["likelihood"] == pytest.approx(small["likelihood"] - 60 * np.log(1e6), abs=1e-3)
