"""Grouped totals, shares of a total, top lists and margins.

A share needs the grand total next to every group. The total is a scalar subquery over the grouped rows: both
sides start from the same aggregate, so the shuffle below is run once and reused, no row goes through the driver, and
no window gathers the groups in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.measures import ratio, total


def totals(lines: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Sum of each measure by key, as `total_<measure>`."""
    return lines.groupBy(*keys).agg(*[total(m) for m in measures])


def line_counts(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("line_count"))


def share_of_total(grouped: DataFrame, value: str, share: str, factor: float = 100.0) -> DataFrame:
    """Add `value / sum(value) * factor`. `value` is an exact number (count or decimal)."""
    whole = grouped.agg(F.sum(value).cast("double")).scalar()
    return grouped.withColumn(share, ratio(F.col(value), whole) * F.lit(factor))


def top(df: DataFrame, n: int, by: str, tie: list[str], largest: bool = True) -> DataFrame:
    """The n rows with the largest (or smallest) `by`; `tie` makes the choice unique."""
    first = F.col(by).desc() if largest else F.col(by).asc()
    return df.orderBy(first, *tie).limit(n)


def with_margin(grouped: DataFrame, profit: str = "total_profit", sales: str = "total_sales") -> DataFrame:
    return grouped.withColumn("profit_margin", ratio(profit, sales))


def sum_numeric(df: DataFrame, keys: list[str], only: list[str] | None = None) -> DataFrame:
    """Sum every numeric column that is no key (or those named), as `sum_<column>`."""
    numeric = only or [
        name
        for name, kind in df.dtypes
        if name not in keys and kind.split("(")[0] in ("int", "bigint", "decimal", "double", "float")
    ]
    kinds = dict(df.dtypes)
    sums = [
        F.sum(c).cast("bigint" if kinds[c] in ("int", "bigint") else "double").alias(f"sum_{c}")
        for c in numeric
    ]
    return df.groupBy(*keys).agg(*sums)


def above_mean_margin(lines: DataFrame, item: list[str]) -> DataFrame:
    """How many items with sales have a margin above the margin of all lines."""
    items = lines.groupBy(*item).agg(F.sum("profit").alias("p"), F.sum("sales").alias("s"))
    mean = items.agg(ratio(F.sum("p"), F.sum("s"))).scalar()
    above: Column = ratio("p", "s") > mean
    return items.filter("s <> 0").agg(
        F.count_if(above).alias("items_above"), F.count(F.lit(1)).alias("items")
    )


def demand_per_1000(lines: DataFrame, place: str) -> DataFrame:
    """Order lines per thousand distinct customers, in one pass."""
    counted = lines.groupBy(place).agg(
        F.count("customer_id").alias("line_count"),
        F.count_distinct("customer_id").alias("customer_count"),
    )
    return counted.withColumn("demand", ratio("line_count", "customer_count") * F.lit(1000.0))
