"""Holt-Winters smoothing of many monthly series at once, inside Spark tasks.

Smoothing is a recursion over months, which no built-in column function runs fast: a higher-order `aggregate` is
interpreted for each series and parameter set. Here an Arrow UDF gets a batch of series and walks the months once
for all of them, with numpy arrays of (series x parameter sets). The UDF is an expression on the series row: Spark
partitions the series, and key columns never leave the JVM.

Start of the recursion: trend = (mean of months 13-24 - mean of months 1-12) / 12, or the twelfth root of the ratio of
the means; the first mean, moved along the trend from the middle of the year, is the level of each month 1-12; season =
difference to, or ratio with, that level. The recursion runs from month 13 on. A straight line with a fixed season is
thus met without error.
Parameters: the set of the grid with the least sum of squared one-step errors, the first in order if equal. `refine` lets a bounded
Nelder-Mead search go on from there: the simplices of all series of a batch move at once, and a series whose simplex has shrunk
to a point stops, so its result does not depend on the others. The error never gets larger than that of the grid.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F

# the functions below travel inside the UDF, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PERIOD = 12

# The parameter sets (alpha, beta, gamma) that are tried, in order.
GRID = [(a, b, g) for a in (0.1, 0.3, 0.5) for b in (0.01, 0.1) for g in (0.1, 0.3)]

RESULT = (
    "status string, alpha double, beta double, gamma double, sse double, steps int, level double, trend double, "
    "forecast array<double>"
)
# Limits of refined parameters, and the width of a simplex that counts as a point.
BOUNDS, TOLERANCE = (1e-4, 0.9999), 1e-5
_CHUNK = 1024  # series walked together; keeps the state of a chunk in the processor cache


def _mean(rows: np.ndarray) -> np.ndarray:
    total = rows[0].copy()
    for row in rows[1:]:  # one after another: numpy's own sum would pair them differently
        total += row
    return total / len(rows)


def _recursion(y: np.ndarray, sets: np.ndarray, multiplicative: bool, misses: list | None = None):
    """y: months x series; sets: (sets x 3) for all series, or (series x sets x 3). Returns errors, level, trend and seasons,
    each of (series x sets). `misses` gets the one-step errors of each month, as a share of the forecast if multiplicative.
    """
    months, count = y.shape
    alpha, beta, gamma = sets[..., 0], sets[..., 1], sets[..., 2]
    keep_a, keep_b, keep_g = 1.0 - alpha, 1.0 - beta, 1.0 - gamma
    first, second = _mean(y[:PERIOD]), _mean(y[PERIOD : 2 * PERIOD])
    middle = (PERIOD + 1) / 2  # the mean of the first year stands for its middle
    away = [i - middle for i in range(1, PERIOD + 1)]
    if multiplicative:
        start = np.power(second / first, 1.0 / PERIOD)
        season = [y[i] / (first * np.power(start, d)) for i, d in enumerate(away)]
        first = first * np.power(start, PERIOD - middle)
    else:
        start = (second - first) / PERIOD
        season = [y[i] - (first + start * d) for i, d in enumerate(away)]
        first = first + start * (PERIOD - middle)
    shape = (count, sets.shape[-2])
    level = np.broadcast_to(first[:, None], shape).copy()
    trend = np.broadcast_to(start[:, None], shape).copy()
    season = [np.broadcast_to(s[:, None], shape).copy() for s in season]
    sse = np.zeros(shape)
    for t in range(PERIOD, months):
        now, old = y[t][:, None], season[t % PERIOD]
        if multiplicative:
            base = level * trend
            error = now - base * old
            new_level = alpha * now / old + keep_a * base
            trend = beta * new_level / level + keep_b * trend
            season[t % PERIOD] = gamma * now / base + keep_g * old
        else:
            rest = now - level - trend
            error = rest - old
            new_level = alpha * (now - old) + keep_a * (level + trend)
            trend = beta * (new_level - level) + keep_b * trend
            season[t % PERIOD] = gamma * rest + keep_g * old
        level = new_level
        sse += error * error
        if misses is not None:
            misses.append(error / (base * old) if multiplicative else error)
    return sse, level, trend, season


def _errors(y: np.ndarray, sets: np.ndarray, multiplicative: bool) -> np.ndarray:
    sse = _recursion(y, sets, multiplicative)[0]
    return np.where(np.isnan(sse), np.inf, sse)


def refined(y: np.ndarray, start: np.ndarray, multiplicative: bool, steps: int) -> np.ndarray:
    """Parameters (series x 3) of at most `steps` moves of a simplex per series from `start`, within `BOUNDS`."""
    best = start.copy()
    apart = np.where(start + 0.1 <= BOUNDS[1], 0.1, -0.1)[:, None, :] * np.vstack([np.zeros(3), np.eye(3)])
    corners = np.clip(start[:, None, :] + apart, *BOUNDS)
    errors = _errors(y, corners, multiplicative)
    moving = np.arange(y.shape[1])
    for _ in range(steps):
        order = np.argsort(errors, axis=1, kind="stable")
        errors = np.take_along_axis(errors, order, axis=1)
        corners = np.take_along_axis(corners, order[:, :, None], axis=1)
        best[moving] = corners[:, 0]
        going = (corners.max(axis=1) - corners.min(axis=1)).max(axis=1) > TOLERANCE
        if not going.any():
            break
        moving, corners, errors = moving[going], corners[going], errors[going]
        centre, worst = corners[:, :3].mean(axis=1), corners[:, 3]
        # reflection, expansion, and contractions to either side
        tried = np.clip(np.stack([centre + k * (centre - worst) for k in (1.0, 2.0, 0.5, -0.5)], axis=1), *BOUNDS)
        there = _errors(y[:, moving], tried, multiplicative)
        least, second, last = errors[:, 0], errors[:, 2], errors[:, 3]
        mirror, further, outer, inner = there.T
        choice = np.where(
            mirror < least, np.where(further < mirror, 1, 0),
            np.where(mirror < second, 0, np.where(mirror < last, np.where(outer <= mirror, 2, 4), np.where(inner < last, 3, 4))),
        )
        taken = choice < 4
        corners[taken, 3] = tried[taken, choice[taken]]
        errors[taken, 3] = there[taken, choice[taken]]
        if not taken.all():
            shrunk = ~taken
            corners[shrunk, 1:] = corners[shrunk, :1] + 0.5 * (corners[shrunk, 1:] - corners[shrunk, :1])
            errors[shrunk, 1:] = _errors(y[:, moving[shrunk]], corners[shrunk, 1:], multiplicative)
    else:
        best[moving] = corners[np.arange(len(moving)), errors.argmin(axis=1)]
    return best


def _walk(y: np.ndarray, sets: np.ndarray, multiplicative: bool, horizon: int):
    """y: months x series. Returns per series the chosen set, its error, level, trend and forecasts."""
    months, count = y.shape
    sse, level, trend, season = _recursion(y, sets, multiplicative)
    best = np.argmin(np.where(np.isnan(sse), np.inf, sse), axis=1)
    pick = (np.arange(count), best)
    level, trend = level[pick], trend[pick]
    ahead = []
    growth = np.ones(count)
    for h in range(1, horizon + 1):
        s = season[(months + h - 1) % PERIOD][pick]
        if multiplicative:
            growth = growth * trend
            ahead.append(level * growth * s)
        else:
            ahead.append(level + h * trend + s)
    return best, sse[pick], level, trend, np.array(ahead).T


def _matrix(at: pa.ListArray, values: pa.ListArray, months: int) -> np.ndarray:
    """Points (position, value) of each series as months x series, 0 where a series has no point."""
    counts = pc.fill_null(pc.list_value_length(at), 0).to_numpy(zero_copy_only=False)
    column = np.repeat(np.arange(len(at)), counts)
    y = np.zeros((months, len(at)))
    y[at.flatten().to_numpy(zero_copy_only=False), column] = values.flatten().to_numpy(zero_copy_only=False)
    return y


class _Fits:
    """Columns of the result for one batch; a series that is not fitted stays null."""

    def __init__(self, count: int, horizon: int):
        self.status = np.full(count, "ok", dtype=object)
        self.numbers = {name: np.zeros(count) for name in ("alpha", "beta", "gamma", "sse", "level", "trend")}
        self.steps = np.zeros(count, dtype=np.int32)
        self.ahead = np.zeros((count, horizon))
        self.lengths = np.full(count, horizon)

    def fit(self, y: np.ndarray, rows: np.ndarray, grid, multiplicative: bool, least: int, horizon: int, refine: int = 0) -> None:
        """Fit the series `y` (months x series), which are the given rows of the batch."""
        self.lengths[rows] = horizon
        status = np.full(len(rows), "ok", dtype=object)
        status[~np.isfinite(y).all(axis=0)] = "nonfinite"
        if multiplicative:
            status[(status == "ok") & (y <= 0).any(axis=0)] = "nonpositive"
        if len(y) < max(least, 2 * PERIOD):
            status[:] = "short"
        self.status[rows] = status
        self.steps[rows] = len(y) - PERIOD
        usable = np.flatnonzero(status == "ok")
        sets = np.array(grid)
        for start in range(0, len(usable), _CHUNK):
            some = usable[start : start + _CHUNK]
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                best, sse, level, trend, ahead = _walk(y[:, some], sets, multiplicative, horizon)
                chosen = sets[best]
                if refine:
                    # the grid's set stays a candidate, and the first one, so the error cannot grow
                    chosen = np.stack([chosen, refined(y[:, some], chosen, multiplicative, refine)], axis=1)
                    best, sse, level, trend, ahead = _walk(y[:, some], chosen, multiplicative, horizon)
                    chosen = chosen[np.arange(len(some)), best]
            found = (*chosen.T, sse, level, trend)
            for name, values in zip(self.numbers, found):
                self.numbers[name][rows[some]] = values
            self.ahead[rows[some], :horizon] = ahead.reshape(len(some), horizon)
            # finite values may still run off to infinity
            lost = ~(np.isfinite(sse) & np.isfinite(ahead.reshape(len(some), horizon)).all(axis=1))
            self.status[rows[some][lost]] = "nonfinite"

    def to_arrow(self) -> pa.Array:
        missing = self.status != "ok"
        lengths = np.where(missing, 0, self.lengths)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        ahead = pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(self.ahead[np.arange(self.ahead.shape[1]) < lengths[:, None]]), mask=pa.array(missing)
        )
        n = {name: pa.array(values, mask=missing) for name, values in self.numbers.items()}
        steps = pa.array(self.steps, mask=missing)
        columns = [
            pa.array(self.status, type=pa.string()), n["alpha"], n["beta"], n["gamma"], n["sse"], steps, n["level"],
            n["trend"], ahead,
        ]
        names = ["status", "alpha", "beta", "gamma", "sse", "steps", "level", "trend", "forecast"]
        return pa.StructArray.from_arrays(columns, names=names)


def holt_winters(
    grid: list[tuple[float, float, float]] = GRID,
    multiplicative: bool = False,
    horizon: int | None = PERIOD,
    train: int | None = None,
    least: int = 2 * PERIOD,
    refine: int = 0,
):
    """An Arrow UDF (positions, values, months) -> RESULT.

    `train` fits on the first so many months only; with `horizon` None all later months are forecast. `refine` is the number of
    steps by which the grid's best set is improved. A series that cannot be fitted gets a status and no forecast,
    and leaves the others alone.
    """

    @F.arrow_udf(RESULT)
    def fit(at: pa.Array, values: pa.Array, months: pa.Array) -> pa.Array:
        lengths = months.to_numpy(zero_copy_only=False)
        wanted = np.maximum(0, lengths - train) if horizon is None else np.full(len(lengths), horizon)
        fits = _Fits(len(lengths), int(wanted.max(initial=0)))
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            whole = len(rows) == len(lengths)
            y = _matrix(
                at if whole else at.take(pa.array(rows)), values if whole else values.take(pa.array(rows)), int(length)
            )
            fits.fit(y[:train] if train else y, rows, grid, multiplicative, least, int(wanted[rows[0]]), refine)
        return fits.to_arrow()

    # equal input gives equal output; the mark keeps the optimizer from running it in a filter and then once more
    return fit.asNondeterministic()


# --- simulated futures ---

PRIME = (1 << 31) - 1
INTERVAL = "status string, lower array<double>, middle array<double>, upper array<double>"
_SIMULATED = 1 << 16  # series x paths that are simulated together


def draws(seed: int, series: np.ndarray, paths: np.ndarray, step: int) -> np.ndarray:
    """Random numbers below 2**31 for (series x paths) at a step: a function of the four numbers alone, so any part of any run
    can be computed anywhere, in any order. All products stay below 2**49.
    """
    k = (((seed + series) % PRIME) * 48271 + 11) % PRIME
    k = ((k[:, None] + paths) % PRIME * 69621 + 7) % PRIME
    k = ((k + step) % PRIME * 48271 + 3) % PRIME
    k = ((k ^ (k >> 15)) * 16807 + 5) % PRIME
    return ((k ^ (k >> 13)) * 48271) % PRIME


def _futures(y: np.ndarray, sets: np.ndarray, series: np.ndarray, multiplicative: bool, horizon: int, paths: int, seed: int, at: list[int]):
    """Order statistics `at` (0-based) of the simulated values, (statistics x series x horizon).

    Each path draws its errors from those of the fit, and the smoothing goes on with the values it gets.
    """
    misses: list[np.ndarray] = []
    _, level, trend, season = _recursion(y, sets[:, None, :], multiplicative, misses)
    errors = np.stack(misses, axis=1)[:, :, 0]  # series x months
    alpha, beta, gamma = (sets[:, i, None] for i in range(3))
    season = [season[(len(y) + h) % PERIOD] for h in range(PERIOD)]
    every, numbers = np.arange(paths), np.arange(len(series))[:, None]
    out = np.empty((len(at), len(series), horizon))
    for h in range(horizon):
        miss = errors[numbers, draws(seed, series, every, h) % errors.shape[1]]
        old = season[h % PERIOD]
        if multiplicative:
            base = level * trend
            value = base * old * (1.0 + miss)
            new_level = alpha * value / old + (1.0 - alpha) * base
            trend = beta * new_level / level + (1.0 - beta) * trend
            season[h % PERIOD] = gamma * value / base + (1.0 - gamma) * old
        else:
            value = level + trend + old + miss
            new_level = alpha * (value - old) + (1.0 - alpha) * (level + trend)
            season[h % PERIOD] = gamma * (value - level - trend) + (1.0 - gamma) * old
            trend = beta * (new_level - level) + (1.0 - beta) * trend
        level = new_level
        ranked = np.sort(np.broadcast_to(value, (len(series), paths)), axis=1)
        out[:, :, h] = ranked[:, at].T
    return out


def simulated_interval(
    grid: list[tuple[float, float, float]] = GRID, multiplicative: bool = False, horizon: int = PERIOD, refine: int = 0, paths: int = 1000,
    seed: int = 1, low: float = 0.025, high: float = 0.975,
):
    """An Arrow UDF (positions, values, months, number) -> INTERVAL: order statistics of simulated paths per month ahead.

    `number` tells series apart: it picks the series' random numbers.
    """
    at = [int(q * (paths - 1)) for q in (low, 0.5, high)]

    @F.arrow_udf(INTERVAL)
    def simulate(at_months: pa.Array, values: pa.Array, months: pa.Array, number: pa.Array) -> pa.Array:
        lengths, ids = months.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False).astype(np.int64) % PRIME
        status = np.full(len(lengths), "short", dtype=object)
        out = np.zeros((3, len(lengths), horizon))
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            y = _matrix(at_months.take(pa.array(rows)), values.take(pa.array(rows)), int(length))
            fits = _Fits(len(rows), 1)
            fits.fit(y, np.arange(len(rows)), grid, multiplicative, 2 * PERIOD + 1, 1, refine)
            status[rows] = fits.status
            usable = np.flatnonzero(fits.status == "ok")
            sets = np.stack([fits.numbers[n] for n in ("alpha", "beta", "gamma")], axis=1)
            step = max(1, _SIMULATED // paths)
            for start in range(0, len(usable), step):
                some = usable[start : start + step]
                with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                    found = _futures(y[:, some], sets[some], ids[rows[some]], multiplicative, horizon, paths, seed, at)
                out[:, rows[some]] = found
                status[rows[some][~np.isfinite(found).all(axis=(0, 2))]] = "nonfinite"
        missing = status != "ok"
        offsets = np.concatenate([[0], np.cumsum(np.where(missing, 0, horizon))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x[~missing].ravel()), mask=pa.array(missing)) for x in out]
        return pa.StructArray.from_arrays([pa.array(status, pa.string()), *lists], names=["status", "lower", "middle", "upper"])

    return simulate.asNondeterministic()
