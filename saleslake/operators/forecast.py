"""Forecasts of monthly panels: Holt-Winters by key, accuracy on held-out months, intervals, seasonal regression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.measures import ratio
from saleslake.operators import panel as panels
from saleslake.operators.smoothing import GRID, PERIOD, holt_winters, simulated_interval


def fits(panel: DataFrame, keys: list[str], measures: list[str], ends: tuple | None = None, **settings) -> DataFrame:
    """One row per key with the fit of each measure as `fit_<measure>` (see smoothing.RESULT).

    `ends` are the first and last month of all series, where the panel holds a part of them only. A key with sums that have no month gets the status `undated` and no forecast.
    """
    smooth = holt_winters(**settings)
    fitted = panels.series(panel, keys, measures, ends=ends).withColumns(
        {f"fit_{m}": smooth(F.col("points.at"), F.col(f"points.{m}"), F.col("months")) for m in measures}
    )

    def marked(fit: Column) -> Column:
        undated = fit.withField("status", F.lit("undated")).withField("forecast", F.lit(None).cast("array<double>"))
        return F.when(F.col("undated") > 0, undated).otherwise(fit)

    return fitted.withColumns({f"fit_{m}": marked(F.col(f"fit_{m}")) for m in measures})


def ahead(fitted: DataFrame, keys: list[str], measures: list[str], start: Column | None = None) -> DataFrame:
    """Fits to rows (month, keys, forecasted_<measure>); by default the months after the last of the panel."""
    start = F.col("last_month") if start is None else start
    joined = F.arrays_zip(*[F.col(f"fit_{m}.forecast").alias(m) for m in measures])
    rows = fitted.select(*keys, start.alias("_start"), F.posexplode(joined).alias("_h", "_f"))
    return rows.select(
        F.add_months("_start", F.col("_h") + 1).alias("month"),
        *keys,
        *[F.col(f"_f.{m}").alias(f"forecasted_{m}") for m in measures],
    )


def forecast(panel: DataFrame, keys: list[str], measures: list[str], grid=GRID, **settings) -> DataFrame:
    """The next 12 months of every key. Keys without a fit are left out; `fit_status` lists them."""
    return ahead(fits(panel, keys, measures, grid=grid, **settings), keys, measures)


def fit_status(panel: DataFrame, keys: list[str], measure: str, **settings) -> DataFrame:
    """Per key: ok, short, nonfinite, nonpositive or undated."""
    return fits(panel, keys, [measure], **settings).select(*keys, F.col(f"fit_{measure}.status").alias("status"))


def holdout(panel: DataFrame, keys: list[str], measure: str, train: int, **settings) -> DataFrame:
    """Fit on the first `train` months; rows of all later months with actual value and forecast."""
    fitted = fits(panel, keys, [measure], train=train, horizon=None, **settings)
    wide = fitted.select(
        *keys,
        F.add_months("first_month", train - 1).alias("_start"),
        F.posexplode(
            F.arrays_zip(
                F.slice(panels.dense(measure), F.lit(train + 1), F.col("months")).alias("actual"),
                F.col(f"fit_{measure}.forecast").alias("forecast"),
            )
        ).alias("_h", "_f"),
    )
    # a series without a fit has nothing to compare with
    return wide.filter("_f.forecast is not null").select(
        F.add_months("_start", F.col("_h") + 1).alias("month"), *keys, "_f.actual", "_f.forecast"
    )


def accuracy(pairs: DataFrame, keys: list[str], actual: str = "actual", predicted: str = "forecast") -> DataFrame:
    """RMSE, R2 and MAPE (in percent) of predictions per key (of all rows without keys)."""
    a, p = F.col(actual), F.col(predicted)
    error = a - p
    grouped = pairs.groupBy(*keys).agg(
        F.avg(error * error).alias("_mse"),
        F.var_pop(a).alias("_variance"),
        F.avg(F.abs(error) / F.greatest(F.abs(a), F.lit(2.220446049250313e-16))).alias("_ape"),
    )
    return grouped.select(
        *keys,
        F.sqrt("_mse").alias("rmse"),
        (F.lit(1.0) - ratio("_mse", "_variance")).alias("r2"),
        (F.col("_ape") * F.lit(100.0)).alias("mape"),
    )


def with_interval(panel: DataFrame, keys: list[str], measure: str, z: float = 1.96, **settings) -> DataFrame:
    """Forecast with lower and upper bound, by the published variance of additive smoothing up to one season ahead.

    var(h) = s2 * (1 + sum over j < h of (alpha * (1 + beta * j))^2), s2 = SSE / number of one-step errors.
    """
    fit = F.col(f"fit_{measure}")
    fitted = fits(panel, keys, [measure], **settings).filter(fit["status"] == "ok")
    rows = fitted.select(*keys, "last_month", fit.alias("fit"), F.posexplode(fit["forecast"]).alias("h", "forecast"))
    alpha, beta = F.col("fit.alpha"), F.col("fit.beta")
    # h is 0-based here, so j runs over 1..h
    spread = F.aggregate(
        F.filter(F.sequence(F.lit(0), F.col("h")), lambda j: j > 0),
        F.lit(1.0),
        lambda total, j: total + (alpha * (F.lit(1.0) + beta * j)) * (alpha * (F.lit(1.0) + beta * j)),
    )
    half = F.lit(z) * F.sqrt(F.col("fit.sse") / F.col("fit.steps") * spread)
    return rows.select(
        F.add_months("last_month", F.col("h") + 1).alias("month"),
        *keys,
        F.col("forecast").alias(f"forecasted_{measure}"),
        (F.col("forecast") - half).alias("lower"),
        (F.col("forecast") + half).alias("upper"),
    )


def series_number(keys: list[str]) -> Column:
    """A number of 24 bits for the key of a series: the same in every run and under every partitioning."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]) if keys else F.lit("")
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("bigint")


def with_simulated_interval(panel: DataFrame, keys: list[str], measure: str, **settings) -> DataFrame:
    """Lower and upper bound and the middle of simulated paths for the next 12 months of every key that can be fitted.

    The errors of the fit are drawn with replacement, so the bounds need no normal law and hold for multiplicative fits as well.
    """
    simulate = simulated_interval(**settings)
    series = panels.series(panel, keys, [measure])
    found = simulate(F.col("points.at"), F.col(f"points.{measure}"), F.col("months"), series_number(keys))
    rows = series.select(*keys, "last_month", found.alias("f")).filter("f.status = 'ok'")
    each = F.posexplode(F.arrays_zip(*[F.col(f"f.{n}").alias(n) for n in ("lower", "middle", "upper")]))
    return rows.select(*keys, "last_month", each.alias("h", "i")).select(
        F.add_months("last_month", F.col("h") + 1).alias("month"), *keys, "i.lower", "i.middle", "i.upper"
    )


def seasonal_regression(panel: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """ARIMA(1,0,0)(0,1,0)12 by conditional least squares, 12 months ahead.

    w(t) = y(t) - y(t-12); phi = sum w(t) w(t-1) / sum w(t-1)^2; y(T+h) = y(T+h-12) + phi^h w(T). All of it is array
    work on the row of one series.
    """
    zero = F.lit(0.0)
    base = panels.series(panel, keys, [measure]).filter(F.col("months") >= 2 * PERIOD)
    base = base.withColumn("y", panels.dense(measure))
    base = base.withColumn(
        "w",
        F.transform(
            F.sequence(F.lit(PERIOD), F.col("months") - 1), lambda t: F.get("y", t) - F.get("y", t - PERIOD)
        ),
    )
    later, earlier = F.slice("w", F.lit(2), F.size("w") - 1), F.slice("w", F.lit(1), F.size("w") - 1)
    products = F.zip_with(later, earlier, lambda a, b: a * b)
    squares = F.transform(earlier, lambda b: b * b)
    base = base.withColumn(
        "phi",
        F.coalesce(
            F.try_divide(
                F.aggregate(products, zero, lambda s, x: s + x), F.aggregate(squares, zero, lambda s, x: s + x)
            ),
            zero,
        ),
    ).withColumn("w_last", F.element_at("w", -1))
    rows = base.select(*keys, "last_month", "phi", "w_last", F.posexplode(F.slice("y", -PERIOD, PERIOD)).alias("h", "back"))
    return rows.select(
        F.add_months("last_month", F.col("h") + 1).alias("month"),
        *keys,
        "phi",
        (F.col("back") + F.pow("phi", F.col("h") + 1) * F.col("w_last")).alias(f"forecasted_{measure}"),
    )
