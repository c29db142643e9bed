"""Column expressions on money and counts.

Money is summed as DECIMAL, so a sum does not depend on the order of the rows; it turns into DOUBLE once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(column: str, name: str | None = None) -> Column:
    return F.sum(column).cast("double").alias(name or f"total_{column}")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division of doubles; NULL where the denominator is zero."""
    numerator = F.col(numerator) if isinstance(numerator, str) else numerator
    denominator = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def log_target(column: str) -> Column:
    return F.log1p(F.col(column).cast("double"))


def log_target_inverse(column: str) -> Column:
    return F.expm1(F.col(column))


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def percentage_error(actual: Column, predicted: Column) -> Column:
    return F.try_divide(absolute_error(actual, predicted), actual) * F.lit(100.0)
