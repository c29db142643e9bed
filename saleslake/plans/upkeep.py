"""Monthly panels and forecasts that are kept up to date: only what has changed is summed and fitted again.

Each version of a panel has marks, one row per month: the number of lines and two sums of their hashes, which do not depend on the order
of the lines. A run computes the marks of the lines as they are, which shuffles a row per month and task, and compares them with those
of the published version. Months whose marks differ are summed from their lines, which a filter on months finds; all
other months are taken over. Series that had or have a value in such a month are fitted again; others keep their forecast, unless the
span of months has changed, which moves every forecast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.dates import month_start
from saleslake.operators import forecast, panel
from saleslake.sources import layers, published
from saleslake.sources.shared import scratch, written


@dataclass(frozen=True)
class Upkeep:
    """What a run did: months and series in all, and those that were summed and fitted again."""

    months: int
    months_summed: int
    series: int
    series_fitted: int


def month_marks(lines: DataFrame, columns: list[str]) -> DataFrame:
    """(month, n, low, high): the number of lines of a month and the sums of both halves of their hashes, as exact integers."""
    number = F.xxhash64(*columns)
    low, high = number.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(number, 32)
    return lines.groupBy(month_start("order_date").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum(low).alias("low"), F.sum(high).alias("high"))


def changed_months(marks: DataFrame, before: DataFrame | None) -> list:
    """Months that are new, gone or different; NULL stands for lines without a date. At most one per month reaches the driver."""
    if before is None:
        return [r["month"] for r in marks.select("month").collect()]
    columns = ["month", "n", "low", "high"]
    either = marks.select(*columns).exceptAll(before.select(*columns)).union(before.select(*columns).exceptAll(marks.select(*columns)))
    return [r["month"] for r in either.select("month").distinct().collect()]


def _in_months(month: Column, months: list) -> Column:
    dated = [m for m in months if m is not None]
    found = F.coalesce(month.isin(dated), F.lit(False)) if dated else F.lit(False)
    return found | month.isNull() if None in months else found


def _same_keys(frame: DataFrame, keys: list[str], some: DataFrame, how: str) -> DataFrame:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return frame.alias("l").join(some.alias("r"), condition, how).select("l.*")


def update(lines: DataFrame, root: str, keys: list[str], measures: list[str], **settings) -> Upkeep:
    """Publish the panel of `lines` and its forecasts below `root`, taking over what has not changed since the version before."""
    spark = lines.sparkSession
    last = published.last_version(spark, root)
    before = {n: published.read_published(spark, root, n) for n in ("marks", "panel", "forecast")} if last else {}
    done = {}

    def build(place: str) -> dict[str, DataFrame]:
        layers.write_gold(month_marks(lines, ["order_date", *keys, *measures]), f"{place}/marks")
        marks = layers.read_gold(spark, f"{place}/marks")
        months = changed_months(marks, before.get("marks"))
        fresh = panel.monthly(lines.filter(_in_months(month_start("order_date"), months)), keys, measures)
        kept = before["panel"].filter(~_in_months(F.col("month"), months)) if last else None
        layers.write_gold(fresh if kept is None else kept.unionByName(fresh), f"{place}/panel")
        now = layers.read_gold(spark, f"{place}/panel")
        ends = now.agg(F.min("month"), F.max("month")).first()
        every = now.select(*keys).dropDuplicates() if keys else now.limit(1)
        same_span = last and ends == before["panel"].agg(F.min("month"), F.max("month")).first()
        if same_span and keys:
            # series with a value in a changed month, now or before
            both = now.unionByName(before["panel"]).filter(_in_months(F.col("month"), months))
            touched = written(both.select(*keys).dropDuplicates(), "touched")
            fitted = _forecast(_same_keys(now, keys, touched, "left_semi"), keys, measures, ends, settings)
            ahead = _same_keys(before["forecast"], keys, touched, "left_anti").unionByName(fitted)
        else:
            touched, ahead = every, _forecast(now, keys, measures, ends, settings)
        layers.write_gold(ahead, f"{place}/forecast")
        done["upkeep"] = Upkeep(marks.count(), len(months), every.count(), touched.count())
        return {"marks": marks, "panel": now, "forecast": layers.read_gold(spark, f"{place}/forecast")}

    with scratch(spark):
        published.publish_tables(spark, root, build, lambda tables: None)
    return done["upkeep"]


def _forecast(some: DataFrame, keys: list[str], measures: list[str], ends, settings: dict) -> DataFrame:
    """Forecasts of some series over the span of months of the whole panel."""
    return forecast.forecast(some, keys, measures, ends=tuple(ends), **settings)
