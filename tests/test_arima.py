"""ARMA fits against dense covariances and plain regressions."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslake.operators import arima


def covariance(phi, theta, n, terms=4000):
    """Autocovariance matrix by the weights of past shocks."""
    psi = np.zeros(terms)
    for j in range(terms):
        psi[j] = (1.0 if j == 0 else theta[j - 1] if j <= len(theta) else 0.0) + sum(c * psi[j - i] for i, c in enumerate(phi, 1) if j >= i)
    gamma = [float(psi[: terms - k] @ psi[k:]) for k in range(n)]
    return np.array([[gamma[abs(i - j)] for j in range(n)] for i in range(n)])


@pytest.mark.parametrize("phi, theta", [([], []), ([0.7], []), ([], [0.5]), ([0.5, -0.3], [0.4]), ([-0.6], [0.3, 0.2]), ([0.2, 0.5], [-0.4, 0.1])])
def test_likelihood_equals_the_dense_normal_density(phi, theta):
    rng = np.random.default_rng(1)
    w = rng.normal(0, 3, (30, 2))
    variance, likelihood, _, _ = arima.filtered(w, np.array([phi] * 2).reshape(2, -1), np.array([theta] * 2).reshape(2, -1))
    cov = covariance(phi, theta, 30)
    for k in range(2):
        square = w[:, k] @ np.linalg.solve(cov, w[:, k])
        assert variance[k] == pytest.approx(square / 30, rel=1e-8)
        density = -0.5 * (30 * math.log(2 * math.pi * variance[k]) + np.linalg.slogdet(cov)[1] + 30)
        assert likelihood[k] == pytest.approx(density, rel=1e-8)


def simulated(phi, theta, n, seed):
    rng = np.random.default_rng(seed)
    e, w = rng.normal(0, 1, n + 200), np.zeros(n + 200)
    for t in range(5, n + 200):
        w[t] = e[t] + sum(c * w[t - i] for i, c in enumerate(phi, 1)) + sum(c * e[t - i] for i, c in enumerate(theta, 1))
    return w[200:]


def test_hannan_rissanen_equals_plain_regressions():
    w = np.stack([simulated([0.6], [0.3], 120, s) for s in range(3)], axis=1)
    phi, theta = arima.hannan_rissanen(w, 1, 1, 4)
    for k in range(3):
        x = w[:, k]
        long = np.array([[x[t - i] for i in range(1, 5)] for t in range(4, 120)])
        e = x[4:] - long @ np.linalg.lstsq(long, x[4:], rcond=None)[0]
        rows = np.array([[x[t - 1], e[t - 5]] for t in range(5, 120)])
        wanted = np.linalg.lstsq(rows, x[5:], rcond=None)[0]
        assert [phi[k, 0], theta[k, 0]] == pytest.approx(wanted.tolist(), rel=1e-6)


def test_orders_and_coefficients_are_found():
    w = np.stack([simulated([0.8], [], 600, 1), simulated([], [0.7], 600, 2), simulated([], [], 600, 3)], axis=1)
    y = np.zeros((612, 3))
    for t in range(600):
        y[t + 12] = y[t] + w[t]
    best = arima.fitted(y, (2, 2), 6, 12)
    assert best.p[0] >= 1 and best.q[1] >= 1
    single = arima.fitted(y, (1, 0), 6, 12)
    assert single.phi[0, 0] == pytest.approx(0.8, abs=0.08) and (single.p[0], single.p[2]) == (1, 0)
    # the value a season ago, and the shrinking difference
    for h in range(12):
        assert single.ahead[0, h] == pytest.approx(y[600 + h, 0] + single.phi[0, 0] ** (h + 1) * w[-1, 0], rel=1e-9)


def test_odd_series_leave_the_others_alone(spark):
    random.seed(4)
    values = {
        "fine": [random.uniform(5, 9) for _ in range(60)], "flat": [4.0] * 60, "line": [float(i) for i in range(60)], "nan": [1.0] * 59 + [float("nan")],
    }
    rows = [(k, date(2000 + i // 12, i % 12 + 1, 1), v) for k, ys in values.items() for i, v in enumerate(ys)]
    panel = spark.createDataFrame(rows, "k string, month date, sales double")
    got = {r.k: r for r in arima.arma_fits(panel, ["k"], "sales").collect()}
    assert {k: r.status for k, r in got.items()} == {"fine": "ok", "flat": "ok", "line": "ok", "nan": "nonfinite"}
    assert got["flat"].forecast == [4.0] * 12 and len(got["fine"].forecast) == 12 and got["nan"].forecast == []
    alone = arima.arma_fits(panel.filter("k = 'fine'"), ["k"], "sales").first()
    assert (alone.p, alone.q) == (got["fine"].p, got["fine"].q) and alone.forecast == pytest.approx(got["fine"].forecast)
    short = arima.arma_fits(panel.filter(F.col("month") < "2002-06-01"), ["k"], "sales").collect()
    assert {r.status for r in short} == {"short"}
    assert arima.arma_forecast(panel, ["k"], "sales").groupBy("k").count().count() == 3
    assert arima.arma_forecast(panel.limit(0), ["k"], "sales").count() == 0
