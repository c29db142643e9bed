from datetime import date

import pytest
from pyspark.sql import functions as F

from saleslake.operators.keys import first_per_key, numbered


@pytest.mark.parametrize("partitions", ["1", "4", "13"])
def test_numbers_follow_the_order_whatever_the_partitions(spark, partitions):
    # a third of the rows share the leading value
    rows = [(0 if i % 3 == 0 else i, f"n{i:04d}") for i in range(3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        result = numbered(spark.createDataFrame(rows, "k int, name string").repartition(7), ["k", "name"], "key")
        got = {(r.k, r.name): r.key for r in result.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {row: i + 1 for i, row in enumerate(sorted(rows))}


def test_descending_and_null_order(spark):
    rows = [(3, "a"), (None, "b"), (7, "c"), (3, "d")]
    result = numbered(spark.createDataFrame(rows, "v int, name string"), [F.desc("v"), F.asc("name")], "key")
    assert [r.name for r in result.orderBy("key").collect()] == ["c", "a", "d", "b"]


def test_empty_table(spark):
    assert numbered(spark.createDataFrame([], "v int"), ["v"], "key").count() == 0


def test_first_per_key(spark):
    rows = [(1, "Zeta", "x"), (1, "Alpha", "y"), (2, None, "z"), (2, "Beta", "w")]
    result = first_per_key(spark.createDataFrame(rows, "id int, name string, kind string"), "id", ["name", "kind"])
    assert {tuple(r) for r in result.collect()} == {(1, "Alpha", "y"), (2, None, "z")}


def test_dates_are_numbered(spark):
    days = [date(2001, 1, d) for d in (9, 2, 5)]
    result = numbered(spark.createDataFrame([(d,) for d in days], "d date"), ["d"], "key")
    assert [r.d for r in result.orderBy("key").collect()] == sorted(days)
