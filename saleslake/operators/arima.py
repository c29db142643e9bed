"""ARMA models of seasonally differenced monthly series, their order chosen by the exact likelihood; many series at once.

w(t) = y(t) - y(t - 12) follows an ARMA(p, q): ARIMA(p,0,q)(0,1,0)12. For every order up to the asked one, coefficients are estimated
by Hannan and Rissanen's two regressions: a long autoregression gives the innovations, then w is regressed on its own past and
on theirs. Normal equations of all series of a batch are solved together. The exact Gaussian likelihood of each fit comes from
a Kalman filter whose state covers (series x state); it starts from the stationary distribution, and the variance is
concentrated out. The order with the least AIC wins, the smaller one among equals. Orders whose estimate isn't stationary and
invertible do not compete; white noise always does.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.operators import panel as panels
from saleslake.operators.smoothing import PERIOD

# the functions below travel inside the UDF, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG = 6  # terms of the autoregression that gives the innovations
INSIDE = 0.999  # largest inverse root that counts as stationary or invertible
RESULT = (
    "status string, p int, q int, phi array<double>, theta array<double>, variance double, log_likelihood double, aic double, "
    "forecast array<double>"
)


def _least_squares(columns: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Coefficients (series x k) of the regression of target (times x series) on the columns, without intercept.

    Where the columns of a series depend on each other, the missing directions get the coefficient 0.
    """
    if not columns:
        return np.zeros((target.shape[1], 0))
    x = np.stack(columns, axis=2).transpose(1, 0, 2)  # series x times x k
    normal, moment = x.transpose(0, 2, 1) @ x, (x.transpose(0, 2, 1) @ target.T[:, :, None])
    if len(columns) == 1:
        scale = normal[:, 0, 0]
        return np.where(scale > 0, moment[:, 0, 0] / np.where(scale > 0, scale, 1.0), 0.0)[:, None]
    sizes = np.abs(normal).max(axis=(1, 2), keepdims=True)
    regular = (sizes[:, 0, 0] > 0) & (np.abs(np.linalg.det(normal / np.where(sizes > 0, sizes, 1.0))) > 1e-12)
    out = np.zeros((len(x), len(columns)))
    out[regular] = np.linalg.solve(normal[regular], moment[regular])[:, :, 0]
    for i in np.flatnonzero(~regular):
        out[i] = np.linalg.lstsq(x[i], target[:, i], rcond=1e-10)[0]
    return out


def innovations(w: np.ndarray, long: int) -> np.ndarray:
    """Residuals (times x series) of the autoregression of `long` terms, for the times from `long` on."""
    past = [w[long - k : len(w) - k] for k in range(1, long + 1)]
    phi = _least_squares(past, w[long:])
    return w[long:] - sum(x * phi[:, k] for k, x in enumerate(past))


def hannan_rissanen(w: np.ndarray, p: int, q: int, long: int) -> tuple[np.ndarray, np.ndarray]:
    """phi (series x p) and theta (series x q) of w (times x series)."""
    if q == 0:
        return _least_squares([w[p - k : len(w) - k] for k in range(1, p + 1)], w[p:]), np.zeros((w.shape[1], 0))
    e = innovations(w, long)
    first = long + max(p, q)
    past = [w[first - k : len(w) - k] for k in range(1, p + 1)]
    shocks = [e[first - long - k : len(e) - k] for k in range(1, q + 1)]
    found = _least_squares([*past, *shocks], w[first:])
    return found[:, :p], found[:, p:]


def _largest_root(coefficients: np.ndarray) -> np.ndarray:
    """Largest modulus of the roots of z^k - c1 z^(k-1) - ... - ck, per series."""
    count, k = coefficients.shape
    if not k:
        return np.zeros(count)
    companion = np.zeros((count, k, k))
    companion[:, 0, :] = coefficients
    companion[:, np.arange(1, k), np.arange(k - 1)] = 1.0
    return np.abs(np.linalg.eigvals(companion)).max(axis=1)


def filtered(w: np.ndarray, phi: np.ndarray, theta: np.ndarray):
    """Kalman filter of w (times x series): variance and log likelihood per series, and the last predicted state and transition."""
    times, count = w.shape
    p, q = phi.shape[1], theta.shape[1]
    r = max(p, q + 1)
    move = np.zeros((count, r, r))
    move[:, :p, 0] = phi
    move[:, np.arange(r - 1), np.arange(1, r)] = 1.0
    shock = np.zeros((count, r, 1))
    shock[:, 0, 0] = 1.0
    shock[:, 1 : q + 1, 0] = theta
    noise = shock @ shock.transpose(0, 2, 1)
    # the stationary covariance solves P = T P T' + R R'
    twice = np.einsum("nij,nkl->nikjl", move, move).reshape(count, r * r, r * r)
    spread = np.linalg.solve(np.eye(r * r) - twice, noise.reshape(count, r * r, 1)).reshape(count, r, r)
    state = np.zeros((count, r, 1))
    squares, logs = np.zeros(count), np.zeros(count)
    for t in range(times):
        miss, scale = w[t] - state[:, 0, 0], spread[:, 0, 0]
        squares += miss * miss / scale
        logs += np.log(scale)
        gain = move @ spread[:, :, :1] / scale[:, None, None]
        state = move @ state + gain * miss[:, None, None]
        spread = move @ spread @ move.transpose(0, 2, 1) + noise - gain @ gain.transpose(0, 2, 1) * scale[:, None, None]
    variance = squares / times
    with np.errstate(divide="ignore"):
        likelihood = -0.5 * times * (np.log(2 * np.pi * variance) + 1.0) - 0.5 * logs
    return variance, likelihood, state, move


def _ahead(y: np.ndarray, state: np.ndarray, move: np.ndarray, horizon: int) -> np.ndarray:
    """Forecasts (series x horizon): the value a season before plus the expected difference."""
    out = list(y)
    for _ in range(horizon):
        out.append(out[-PERIOD] + state[:, 0, 0])
        state = move @ state
    return np.array(out[len(y) :]).T


class _Best:
    """For each series the best order so far."""

    def __init__(self, count: int, orders: int, horizon: int):
        self.p, self.q = np.zeros(count, dtype=np.int32), np.zeros(count, dtype=np.int32)
        self.phi, self.theta = np.zeros((count, orders)), np.zeros((count, orders))
        self.numbers = {name: np.full(count, np.inf) for name in ("variance", "log_likelihood", "aic")}
        self.ahead = np.zeros((count, horizon))

    def take(self, rows: np.ndarray, phi, theta, variance, likelihood, aic, ahead) -> None:
        p, q = phi.shape[1], theta.shape[1]
        self.p[rows], self.q[rows] = p, q
        self.phi[rows], self.theta[rows] = 0.0, 0.0
        self.phi[rows, :p], self.theta[rows, :q] = phi, theta
        for name, values in (("variance", variance), ("log_likelihood", likelihood), ("aic", aic)):
            self.numbers[name][rows] = values
        self.ahead[rows] = ahead


def fitted(y: np.ndarray, most: tuple[int, int], long: int, horizon: int) -> _Best:
    """The best order of each series of y (months x series), up to `most` = (p, q)."""
    w = y[PERIOD:] - y[:-PERIOD]
    best = _Best(y.shape[1], max(1, *most), horizon)
    for p, q in sorted(itertools.product(range(most[0] + 1), range(most[1] + 1)), key=lambda o: (sum(o), o)):
        phi, theta = hannan_rissanen(w, p, q, long)
        fits = (_largest_root(phi) <= INSIDE) & (_largest_root(-theta) <= INSIDE)
        rows = np.flatnonzero(fits)
        if not len(rows):
            continue
        phi, theta = phi[rows], theta[rows]
        variance, likelihood, state, move = filtered(w[:, rows], phi, theta)
        aic = 2 * (p + q + 1) - 2 * likelihood
        # a series of no variance has an infinite likelihood, and keeps the first order
        better = (aic < best.numbers["aic"][rows] - 1e-9) | ((p, q) == (0, 0))
        at = rows[better]
        ahead = _ahead(y[:, at], state[better], move[better], horizon)
        best.take(at, phi[better], theta[better], variance[better], likelihood[better], aic[better], ahead)
    return best


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[np.arange(values.shape[1]) < lengths[:, None]]))


def arma(most: tuple[int, int] = (2, 2), long: int = LONG, horizon: int = PERIOD, least: int | None = None):
    """An Arrow UDF (positions, values, months) -> RESULT; a series that is too short, or not finite, gets a status only."""
    needed = 2 * PERIOD + long + 2 * max(most) if least is None else least

    @F.arrow_udf(RESULT)
    def fit(at: pa.Array, values: pa.Array, months: pa.Array) -> pa.Array:
        lengths = months.to_numpy(zero_copy_only=False)
        count = len(lengths)
        out, status = _Best(count, max(1, *most), horizon), np.full(count, "short", dtype=object)
        sizes = pc.fill_null(pc.list_value_length(at), 0).to_numpy(zero_copy_only=False)
        for length in np.unique(lengths[lengths >= needed]):
            rows = np.flatnonzero(lengths == length)
            y = np.zeros((int(length), len(rows)))
            some_at, some = at.take(pa.array(rows)), values.take(pa.array(rows))
            y[some_at.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(rows)), sizes[rows])] = some.flatten().to_numpy(zero_copy_only=False)
            finite = np.isfinite(y).all(axis=0)
            status[rows] = np.where(finite, "ok", "nonfinite")
            usable = np.flatnonzero(finite)
            for start in range(0, len(usable), 2048):
                part = usable[start : start + 2048]
                best = fitted(y[:, part], most, long, horizon)
                to = rows[part]
                out.p[to], out.q[to], out.phi[to], out.theta[to], out.ahead[to] = best.p, best.q, best.phi, best.theta, best.ahead
                for name in out.numbers:
                    out.numbers[name][to] = best.numbers[name]
        missing = status != "ok"
        number = lambda x: pa.array(x, mask=missing)
        fine = (~missing).astype(np.int64)
        columns = [
            pa.array(status, pa.string()), number(out.p), number(out.q), _lists(out.phi, out.p * fine), _lists(out.theta, out.q * fine),
            *[number(out.numbers[n]) for n in ("variance", "log_likelihood", "aic")], _lists(out.ahead, horizon * fine),
        ]
        names = ["status", "p", "q", "phi", "theta", "variance", "log_likelihood", "aic", "forecast"]
        return pa.StructArray.from_arrays(columns, names=names)

    return fit.asNondeterministic()


def arma_coefficients(p: int, q: int, long: int = LONG):
    """An Arrow UDF (points as values of all months) -> (phi, theta) of one order, as the regressions give them."""

    @F.arrow_udf("phi array<double>, theta array<double>")
    def fit(values: pa.Array) -> pa.Array:
        lengths = values.value_lengths().to_numpy(zero_copy_only=False)
        phi, theta = np.zeros((len(lengths), p)), np.zeros((len(lengths), q))
        fits = lengths >= PERIOD + 2 * (long + p + q)
        for length in np.unique(lengths[fits]):
            rows = np.flatnonzero(lengths == length)
            y = values.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1).T
            phi[rows], theta[rows] = hannan_rissanen(y[PERIOD:] - y[:-PERIOD], p, q, long)
        ones = fits.astype(np.int64)
        return pa.StructArray.from_arrays([_lists(phi, p * ones), _lists(theta, q * ones)], names=["phi", "theta"])

    return fit.asNondeterministic()


def arma_fits(panel: DataFrame, keys: list[str], measure: str, **settings) -> DataFrame:
    """Keys, `last_month` and the fields of RESULT, one row per key."""
    series = panels.series(panel, keys, [measure])
    fit = arma(**settings)(F.col("points.at"), F.col(f"points.{measure}"), F.col("months"))
    return series.select(*keys, "last_month", fit.alias("fit")).select(*keys, "last_month", "fit.*")


def arma_forecast(panel: DataFrame, keys: list[str], measure: str, **settings) -> DataFrame:
    """The next 12 months of every key that could be fitted."""
    rows = arma_fits(panel, keys, measure, **settings).filter("status = 'ok'")
    each = rows.select(*keys, "last_month", "p", "q", F.posexplode("forecast").alias("h", "value"))
    return each.select(F.add_months("last_month", F.col("h") + 1).alias("month"), *keys, "p", "q", F.col("value").alias(f"forecasted_{measure}"))
