"""The registry of runnable queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saleslake.sources.order_lines import lines_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Prefix of an oracle that reads the order-line model.
LINES = f"with recursive lines as ({lines_sql()})"


def query(name: str, sql: str | None = None):
    """Register a (spark, folder) -> DataFrame function, with its SQL where SQL can say it."""

    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
