"""Panels and smoothing against plain Python."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from saleslake.operators import forecast as fc
from saleslake.operators import panel as panels
from saleslake.operators.smoothing import BOUNDS, GRID


def month(i):
    return date(2000 + i // 12, i % 12 + 1, 1)


def frame(spark, values: dict):
    rows = [(k, month(i), v) for k, ys in values.items() for i, v in enumerate(ys) if v is not None]
    return spark.createDataFrame(rows, "k string, month date, sales double")


def brute_force(ys, multiplicative=False, horizon=12):
    best = None
    for a, b, g in GRID:
        level, second = sum(ys[:12]) / 12, sum(ys[12:24]) / 12
        trend = (second / level) ** (1 / 12) if multiplicative else (second - level) / 12
        line = [level * trend ** (i - 6.5) if multiplicative else level + trend * (i - 6.5) for i in range(1, 13)]
        season = [y / v if multiplicative else y - v for y, v in zip(ys, line)]
        level = line[-1]
        sse = 0.0
        for y in ys[12:]:
            old = season.pop(0)
            if multiplicative:
                base = level * trend
                new = a * y / old + (1 - a) * base
                sse += (y - base * old) ** 2
                season.append(g * y / base + (1 - g) * old)
                trend = b * new / level + (1 - b) * trend
            else:
                new = a * (y - old) + (1 - a) * (level + trend)
                sse += (y - level - trend - old) ** 2
                season.append(g * (y - level - trend) + (1 - g) * old)
                trend = b * (new - level) + (1 - b) * trend
            level = new
        if best is None or sse < best[0]:
            ahead = [
                (level * trend**h * season[(h - 1) % 12]) if multiplicative else (level + h * trend + season[(h - 1) % 12])
                for h in range(1, horizon + 1)
            ]
            best = (sse, ahead)
    return best[1]


@pytest.mark.parametrize("multiplicative", [False, True])
def test_forecast_equals_brute_force(spark, multiplicative):
    random.seed(3)
    values = {f"s{i}": [random.uniform(50, 150) + 5 * j for j in range(40)] for i in range(7)}
    result = fc.forecast(frame(spark, values), ["k"], ["sales"], multiplicative=multiplicative)
    got = {}
    for r in result.orderBy("k", "month").collect():
        got.setdefault(r.k, []).append(r.forecasted_sales)
    for key, ys in values.items():
        assert got[key] == pytest.approx(brute_force(ys, multiplicative), rel=1e-9)
    assert result.agg(F.min("month"), F.max("month")).first()[:] == (month(40), month(51))


def test_missing_months_count_as_zero(spark):
    random.seed(5)
    full = [random.uniform(1, 9) for _ in range(30)]
    gaps = [v if i % 4 else None for i, v in enumerate(full)]
    result = fc.forecast(frame(spark, {"full": full, "gaps": gaps}), ["k"], ["sales"])
    got = [r.forecasted_sales for r in result.filter("k = 'gaps'").orderBy("month").collect()]
    assert got == pytest.approx(brute_force([v or 0.0 for v in gaps]), rel=1e-9)


def test_periodic_line_is_fitted_without_error(spark):
    values = {"p": [100.0 + 2 * i + (i % 12) * 3 for i in range(48)]}
    fit = fc.fits(frame(spark, values), ["k"], ["sales"]).select("fit_sales.*").first()
    assert fit.status == "ok" and fit.sse < 1e-12 and fit.steps == 36


def test_series_that_cannot_be_fitted_leave_the_others_alone(spark):
    values = {"fine": [5.0 + i % 12 for i in range(30)], "zero": [0.0] * 30, "nan": [1.0] * 29 + [float("nan")]}
    panel = frame(spark, values)
    status = {r.k: r.status for r in fc.fit_status(panel, ["k"], "sales", multiplicative=True).collect()}
    assert status == {"fine": "ok", "zero": "nonpositive", "nan": "nonfinite"}
    assert {r.k for r in fc.forecast(panel, ["k"], ["sales"], multiplicative=True).collect()} == {"fine"}
    short = fc.fit_status(frame(spark, {"s": [1.0] * 20}), ["k"], "sales").first()
    assert short.status == "short"


def test_several_measures_are_fitted_apart(spark):
    rows = [("x", month(i), float(i % 12), float(i)) for i in range(36)]
    panel = spark.createDataFrame(rows, "k string, month date, sales double, profit double")
    result = fc.forecast(panel, ["k"], ["sales", "profit"]).orderBy("month").collect()
    assert [r.forecasted_sales for r in result] == pytest.approx(brute_force([r[2] for r in rows]))
    assert [r.forecasted_profit for r in result] == pytest.approx(brute_force([r[3] for r in rows]))


def test_interval_grows_and_contains_the_forecast(spark):
    random.seed(9)
    panel = frame(spark, {"k": [random.uniform(50, 90) for _ in range(40)]})
    rows = fc.with_interval(panel, ["k"], "sales").orderBy("month").collect()
    widths = [r.upper - r.lower for r in rows]
    assert all(r.lower < r.forecasted_sales < r.upper for r in rows) and widths == sorted(widths)


def test_seasonal_regression_repeats_a_steady_year(spark):
    rows = fc.seasonal_regression(frame(spark, {"k": [float(i % 12) for i in range(36)]}), ["k"], "sales")
    assert [r.forecasted_sales for r in rows.orderBy("month").collect()] == [float(i) for i in range(12)]


def test_decomposition_multiplies_back(spark):
    random.seed(2)
    panel = frame(spark, {"a": [random.uniform(5, 9) for _ in range(40)], "b": [random.uniform(50, 90) for _ in range(40)]})
    rows = panels.decompose(panel, ["k"], "sales").collect()
    inner = [r for r in rows if r.trend is not None]
    assert len(inner) == 2 * 28
    assert all(math.isclose(r.trend * r.seasonal * r.resid, r.sales, rel_tol=1e-9) for r in inner)
    for key in "ab":
        seasonal = {r.month.month: r.seasonal for r in rows if r.k == key}
        assert sum(seasonal.values()) / 12 == pytest.approx(1.0)


def test_grains_equal_separate_panels(spark):
    rows = [(f"c{i % 3}", f"s{i % 7}", date(2001, 1 + i % 4, 1 + i % 28), i) for i in range(500)]
    lines = spark.createDataFrame(rows, "c string, s string, order_date date, sales int")
    grains = [[], ["c"], ["s"], ["c", "s"]]
    both = panels.monthly_grains(lines, grains, ["sales"])
    for number, keys in enumerate(grains):
        got = {tuple(r) for r in both.filter(F.col("grain") == number).select("month", *keys, "sales").collect()}
        assert got == {tuple(r) for r in panels.monthly(lines, keys, ["sales"]).select("month", *keys, "sales").collect()}


def test_padded_and_lag(spark):
    panel = frame(spark, {"a": [1.0, None, None, 4.0], "b": [None, 2.0, None, None]})
    rows = panels.lag_and_rolling(panels.padded(panel, ["k"], ["sales"]), ["k"], "sales").orderBy("k", "month").collect()
    assert [r.sales for r in rows] == [1.0, 0.0, 0.0, 4.0, 0.0, 2.0, 0.0, 0.0]
    assert [r.sales_lag_1 for r in rows] == [None, 1.0, 0.0, 0.0, None, 0.0, 2.0, 0.0]
    assert rows[3].sales_rolling_avg_3m == pytest.approx(4 / 3)


def test_no_month_is_left_out(spark):
    """Two more years of lines are seen by every operator of series."""
    lines = spark.range(0, 72).selectExpr(
        "add_months(date '1996-01-10', cast(id as int)) as order_date", "cast(100 + id as decimal(18,4)) as sales", "'k' as k"
    )
    short = lines.filter("order_date < date '2000-01-01'")
    for operator in (
        lambda p: panels.spine(p).agg(F.max("month")),
        lambda p: panels.padded(p, ["k"], ["sales"]).agg(F.max("month")),
        lambda p: fc.forecast(p, ["k"], ["sales"]).agg(F.add_months(F.min("month"), -1)),
        lambda p: fc.seasonal_regression(p, ["k"], "sales").agg(F.add_months(F.min("month"), -1)),
        lambda p: fc.with_interval(p, ["k"], "sales").agg(F.add_months(F.min("month"), -1)),
        lambda p: fc.holdout(p, ["k"], "sales", train=36).agg(F.max("month")),
        lambda p: panels.decompose(panels.padded(p, ["k"], ["sales"], exact=True), ["k"], "sales").agg(F.max("month")),
    ):
        assert operator(panels.monthly(lines, ["k"], ["sales"])).first()[0] == date(2001, 12, 1)
        assert operator(panels.monthly(short, ["k"], ["sales"])).first()[0] == date(1999, 12, 1)
    assert panels.monthly(lines, ["k"], ["sales"], whole_months=True).agg(F.max("month")).first()[0] == date(2001, 11, 1)
    ended = lines.union(spark.sql("select date '2001-12-31', cast(1 as decimal(18,4)), 'k'"))
    assert panels.monthly(ended, ["k"], ["sales"], whole_months=True).agg(F.max("month")).first()[0] == date(2001, 12, 1)


def test_lines_without_a_month_leave_other_series_alone(spark):
    values = {"fine": [5.0 + i % 12 for i in range(30)], "lost": [3.0 + i % 12 for i in range(30)]}
    panel = frame(spark, values).union(spark.createDataFrame([("lost", None, 7.0)], "k string, month date, sales double"))
    status = {r.k: r.status for r in fc.fit_status(panel, ["k"], "sales").collect()}
    assert status == {"fine": "ok", "lost": "undated"}
    assert {r.k for r in fc.forecast(panel, ["k"], ["sales"]).collect()} == {"fine"}
    assert panels.padded(panel, ["k"], ["sales"]).count() == 60


def test_values_that_run_off_get_a_status(spark):
    panel = frame(spark, {"huge": [1e300 * (1 + i * 7 % 5) for i in range(30)], "fine": [1.0 + i % 3 for i in range(30)]})
    assert {r.k: r.status for r in fc.fit_status(panel, ["k"], "sales").collect()} == {"huge": "nonfinite", "fine": "ok"}


def test_decomposition_of_a_series_with_a_gap(spark):
    full = [5.0 + i % 12 for i in range(40)]
    gap = [v if i != 17 else None for i, v in enumerate(full)]
    panel = frame(spark, {"a": full, "g": gap})
    rows = panels.decompose(panels.padded(panel, ["k"], ["sales"]), ["k"], "sales").filter("k = 'g'").orderBy("month").collect()
    ys = [v or 0.0 for v in gap]
    want = [(2 * sum(ys[i - 5 : i + 6]) + ys[i - 6] + ys[i + 6]) / 24 for i in range(6, 34)]
    assert [r.trend for r in rows[6:34]] == pytest.approx(want)


@pytest.mark.parametrize("multiplicative", [False, True])
def test_refined_parameters_against_a_dense_grid(spark, multiplicative):
    """Never worse than the grid, nor than any of 1,000 sets; and the same for a series alone as among others."""
    random.seed(11)
    values = {f"s{i}": [random.uniform(50, 150) * (1 + 0.3 * math.sin(j / 2 + i)) + 3 * j for j in range(48)] for i in range(9)}
    panel = frame(spark, values)
    dense = [(a / 10 + 0.05, b / 10 + 0.01, g / 10 + 0.05) for a in range(10) for b in range(10) for g in range(10)]

    def errors(some, **settings):
        rows = fc.fits(some, ["k"], ["sales"], multiplicative=multiplicative, **settings).select("k", "fit_sales.*").collect()
        return {r.k: r for r in rows}

    grid, fine, best = errors(panel), errors(panel, refine=200), errors(panel, grid=dense)
    for k in values:
        assert fine[k].sse <= grid[k].sse and fine[k].sse <= best[k].sse * 1.02
        assert all(BOUNDS[0] <= p <= BOUNDS[1] for p in (fine[k].alpha, fine[k].beta, fine[k].gamma))
        alone = errors(panel.filter(F.col("k") == k), refine=200)[k]
        assert alone == fine[k]
    assert sum(fine[k].sse < 0.999 * grid[k].sse for k in values) >= 5


def test_refined_error_is_that_of_the_parameters(spark):
    random.seed(12)
    values = {"a": [random.uniform(50, 150) + j for j in range(40)]}
    fit = fc.fits(frame(spark, values), ["k"], ["sales"], refine=80).select("fit_sales.*").first()
    same = fc.fits(frame(spark, values), ["k"], ["sales"], grid=[(fit.alpha, fit.beta, fit.gamma)]).select("fit_sales.*").first()
    assert (same.sse, same.level, same.forecast) == (fit.sse, fit.level, fit.forecast)


def test_refinement_leaves_broken_series_alone(spark):
    values = {"fine": [5.0 + i % 12 + (i * 7 % 5) for i in range(30)], "zero": [0.0] * 30, "flat": [4.0] * 30}
    status = {r.k: r.status for r in fc.fit_status(frame(spark, values), ["k"], "sales", multiplicative=True, refine=50).collect()}
    assert status == {"fine": "ok", "zero": "nonpositive", "flat": "ok"}


def plain_draw(seed, series, path, step):
    m = (1 << 31) - 1
    k = (((seed + series) % m) * 48271 + 11) % m
    k = ((k + path) % m * 69621 + 7) % m
    k = ((k + step) % m * 48271 + 3) % m
    k = ((k ^ (k >> 15)) * 16807 + 5) % m
    return ((k ^ (k >> 13)) * 48271) % m


def test_draws_are_spread_evenly_and_depend_on_their_numbers_alone():
    import numpy as np

    from saleslake.operators.smoothing import draws

    got = draws(3, np.array([5, 9, 1 << 24]), np.arange(40), 2)
    assert [[plain_draw(3, s, p, 2) for p in range(40)] for s in (5, 9, 1 << 24)] == got.tolist()
    many = np.stack([draws(1, np.arange(20), np.arange(500), h) for h in range(12)])
    counts = np.bincount((many % 36).ravel(), minlength=36)
    assert abs(counts - many.size / 36).max() < 5 * (many.size / 36) ** 0.5
    # neighbouring paths, steps and series are not alike
    for a, b in ((many[:, :, 1:], many[:, :, :-1]), (many[1:], many[:-1]), (many[:, 1:], many[:, :-1])):
        assert abs(np.corrcoef(a.ravel(), b.ravel())[0, 1]) < 0.02


@pytest.mark.parametrize("multiplicative", [False, True])
def test_simulated_interval_against_plain_paths(spark, multiplicative):
    random.seed(13)
    ys = [random.uniform(50, 150) + j for j in range(40)]
    panel = frame(spark, {"a": ys, "b": [random.uniform(5, 9) for _ in range(40)]})
    fit = {r.k: r.fit_sales for r in fc.fits(panel, ["k"], ["sales"], multiplicative=multiplicative).collect()}["a"]
    number = {r.k: r.n for r in panel.select("k", fc.series_number(["k"]).alias("n")).distinct().collect()}["a"]
    found = fc.with_simulated_interval(panel, ["k"], "sales", multiplicative=multiplicative, paths=60, seed=5).filter("k = 'a'").orderBy("month").collect()

    # the walk of the fit, with its errors and last state
    a, b, g = fit.alpha, fit.beta, fit.gamma
    level, second = sum(ys[:12]) / 12, sum(ys[12:24]) / 12
    trend = (second / level) ** (1 / 12) if multiplicative else (second - level) / 12
    line = [level * trend ** (i - 6.5) if multiplicative else level + trend * (i - 6.5) for i in range(1, 13)]
    season, level, errors = [y / v if multiplicative else y - v for y, v in zip(ys, line)], line[-1], []

    def step(level, trend, season, y):
        old = season[0]
        if multiplicative:
            new = a * y / old + (1 - a) * level * trend
            return new, b * new / level + (1 - b) * trend, [*season[1:], g * y / (level * trend) + (1 - g) * old]
        new = a * (y - old) + (1 - a) * (level + trend)
        return new, b * (new - level) + (1 - b) * trend, [*season[1:], g * (y - level - trend) + (1 - g) * old]

    for y in ys[12:]:
        expected = level * trend * season[0] if multiplicative else level + trend + season[0]
        errors.append(y / expected - 1 if multiplicative else y - expected)
        level, trend, season = step(level, trend, season, y)
    values = []
    for path in range(60):
        state, values_of = (level, trend, season), []
        for h in range(12):
            miss = errors[plain_draw(5, number, path, h) % len(errors)]
            y = state[0] * state[1] * state[2][0] * (1 + miss) if multiplicative else state[0] + state[1] + state[2][0] + miss
            values_of.append(y)
            state = step(*state, y)
        values.append(values_of)
    for h, row in enumerate(found):
        ranked = sorted(v[h] for v in values)
        assert [row.lower, row.middle, row.upper] == pytest.approx([ranked[int(q * 59)] for q in (0.025, 0.5, 0.975)], rel=1e-9)
    alone = fc.with_simulated_interval(panel.filter("k = 'a'"), ["k"], "sales", multiplicative=multiplicative, paths=60, seed=5)
    assert [r.upper for r in alone.orderBy("month").collect()] == pytest.approx([r.upper for r in found])
