"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BRONZE_FORMAT = "dd-MM-yyyy"


def parse_date(text: Column) -> Column:
    """Bronze text to DATE; unreadable text becomes NULL."""
    return F.try_to_date(text, BRONZE_FORMAT)


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_parts(prefix: str, day: str) -> list[Column]:
    """year, month, day and quarter of `day`, named with `prefix`."""
    return [
        F.year(day).alias(f"{prefix}_year"),
        F.month(day).alias(f"{prefix}_month"),
        F.dayofmonth(day).alias(f"{prefix}_day"),
        F.quarter(day).alias(f"{prefix}_quarter"),
    ]


def shipment_days(ship: str = "ship_date", order: str = "order_date") -> Column:
    return F.datediff(ship, order)


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months from one month start to another."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
