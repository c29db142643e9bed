"""Monthly panels: sums by month and key, padding of missing months, many grains in one pass, monthly features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.functions.dates import month_start, months_between_starts


def monthly(lines: DataFrame, keys: list[str], measures: list[str], whole_months: bool = False) -> DataFrame:
    """Exact sums per month and key; columns month, keys, measures.

    `whole_months` leaves out the last month if no line is dated on its last day, so that a month that is still
    running does not count as a weak one. The day is found in the aggregate itself, not by a second pass over the lines.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    by_month = lines.groupBy(month_start("order_date").alias("month"), *keys)
    if not whole_months:
        return by_month.agg(*sums)
    panel = by_month.agg(*sums, F.max("order_date").alias("_seen"))
    latest = panel.agg(F.struct(F.max("_seen").alias("day"), *[F.count(m) for m in measures])).scalar().getField("day")
    running = latest < F.last_day(latest)
    end = F.when(running, F.trunc(latest, "MM")).otherwise(F.add_months(F.trunc(latest, "MM"), 1))
    return panel.filter(F.col("month").isNull() | (F.col("month") < end)).drop("_seen")


def daily(lines: DataFrame, measures: list[str]) -> DataFrame:
    return lines.groupBy("order_date").agg(*[F.sum(m).alias(m) for m in measures])


def monthly_grains(lines: DataFrame, grains: list[list[str]], measures: list[str]) -> DataFrame:
    """The panels of several grains from one pass; `grain` is the position of the grain in the list.

    The lines are first summed to the union of all keys, so the expansion into grains multiplies the small panel and
    not the lines.
    """
    keys = list(dict.fromkeys(k for grain in grains for k in grain))
    finest = monthly(lines, keys, measures)
    sets = [[F.col("month"), *[F.col(k) for k in grain]] for grain in grains]
    grouped = finest.groupingSets(sets, "month", *keys).agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping_id().alias("_id")
    )
    number: Column | None = None
    for position, grain in enumerate(grains):
        # bit set = key summed away, first grouping column (month) highest; month is never summed away
        bits = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in grain)
        condition = F.col("_id") == bits
        number = F.when(condition, position) if number is None else number.when(condition, position)
    return grouped.select(number.alias("grain"), "month", *keys, *measures)


def span(panel: DataFrame, measures: list[str]) -> tuple[Column, Column]:
    """First and last month of the whole panel, as a scalar subquery.

    The measures are counted along: then the subquery needs the same aggregate as the panel itself and reuses its
    shuffle. Without them the optimizer would find the months by a second pass over the lines.
    """
    ends = F.struct(F.min("month").alias("first"), F.max("month").alias("last"), *[F.count(m) for m in measures])
    found = panel.agg(ends).scalar()
    return found.getField("first"), found.getField("last")


def series(panel: DataFrame, keys: list[str], measures: list[str], exact: bool = False, ends: tuple | None = None) -> DataFrame:
    """One row per key: `points` (position of the month and measures), `first_month`, `last_month`, `months`, `undated`.

    All series get the span of the whole panel, or that from the first to the second month of `ends`. A series has at most one point per month, so its row stays small
    however many lines are behind it. Sums without a month are no points; `undated` counts them. Measures are doubles, or
    with `exact` keep their type.
    """
    first, last = span(panel, measures) if ends is None else (F.lit(e).cast("date") for e in ends)
    at = panel.withColumn("first_month", first).withColumn("last_month", last)
    point = F.struct(
        months_between_starts(F.col("month"), F.col("first_month")).alias("at"),
        *[(F.col(m) if exact else F.col(m).cast("double")).alias(m) for m in measures],
    )
    dated = F.when(F.col("month").isNotNull(), point)  # collect_list leaves nulls out
    # the span is equal in all rows; without keys it makes one series of the whole panel
    return at.groupBy(*keys, "first_month", "last_month").agg(
        F.collect_list(dated).alias("points"), F.count_if(F.col("month").isNull()).alias("undated")
    ).withColumn("months", F.coalesce(months_between_starts(F.col("last_month"), F.col("first_month")) + 1, F.lit(0)))


def dense(measure: str) -> Column:
    """The values of one measure for every month of the span, 0 where the series has none."""
    known = F.map_from_arrays(F.col("points.at"), F.col(f"points.{measure}"))
    return F.transform(
        F.filter(F.sequence(F.lit(0), F.col("months")), lambda i: i < F.col("months")),
        lambda i: F.coalesce(F.try_element_at(known, i), F.lit(0)),
    )


def padded(panel: DataFrame, keys: list[str], measures: list[str], exact: bool = False) -> DataFrame:
    """The panel with a row for every key and every month of the whole span; sums without a month are left out."""
    wide = series(panel, keys, measures, exact).select(
        *keys, "first_month", F.arrays_zip(*[dense(m).alias(m) for m in measures]).alias("rows")
    )
    return wide.select(*keys, "first_month", F.posexplode("rows").alias("at", "row")).select(
        F.add_months("first_month", F.col("at")).alias("month"), *keys, *[F.col(f"row.{m}").alias(m) for m in measures]
    )


def spine(panel: DataFrame) -> DataFrame:
    """Every month from the first to the last of the panel."""
    ends = panel.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    return ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))


def lag_and_rolling(full: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Previous month and mean of the last three months, per key of a padded panel."""
    ordered = Window.partitionBy(*keys).orderBy("month")
    return full.withColumn("sales_lag_1", F.lag(measure, 1).over(ordered)).withColumn(
        "sales_rolling_avg_3m", F.avg(measure).over(ordered.rowsBetween(-2, 0))
    )


def split_by_position(panel: DataFrame, keys: list[str], train_months: int) -> DataFrame:
    """Mark the first `train_months` months of a padded panel as train, the rest as test."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("month"))
    return panel.withColumn("part", F.when(place <= train_months, "train").otherwise("test"))


def decompose(full: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Multiplicative decomposition with period 12 of a padded panel: trend, seasonal, resid.

    The trend is the centred mean over 2 x 12 months, the seasonal part the mean ratio of each calendar position
    scaled to mean 1. Windows run over the months of one key, which are few.
    """
    ordered = Window.partitionBy(*keys).orderBy("month")
    inner = F.sum(measure).over(ordered.rowsBetween(-5, 5))
    ends = F.lag(measure, 6).over(ordered) + F.lead(measure, 6).over(ordered)
    trend = (F.lit(2) * inner + ends).cast("double") / F.lit(24.0)
    at = full.withColumn("trend", trend).withColumn("y", F.col(measure).cast("double"))
    at = at.withColumn("ratio", F.try_divide("y", "trend")).withColumn("position", F.month("month"))
    position = Window.partitionBy(*keys, "position")
    at = at.withColumn("raw", F.avg("ratio").over(position))
    # every position occurs with its own mean, so the mean over positions is taken on one row of each
    first = F.row_number().over(position.orderBy("month")) == 1
    at = at.withColumn("lead_raw", F.when(first, F.col("raw")))
    scale = F.avg("lead_raw").over(Window.partitionBy(*keys))
    at = at.withColumn("seasonal", F.try_divide(F.col("raw"), scale))
    return at.select(
        "month", *keys, F.col("y").alias(measure), "trend", "seasonal",
        F.try_divide("y", F.col("trend") * F.col("seasonal")).alias("resid"),
    )
