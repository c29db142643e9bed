"""Readers and writers of the bronze (CSV), silver (parquet) and gold (table format of choice) layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saleslake.schema import all_text


def read_bronze(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """CSV with a header line, every column text. Giving the header saves the job that would read it; a file with another one is an
    error then. Broken lines are not told from whole ones here, see `rescue.read_rescued`.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
    if header:
        reader = reader.schema(all_text(header)).option("enforceSchema", False)
    return reader.csv(path)


def write_bronze(df: DataFrame, path: str, compression: str = "none") -> None:
    """Compressed files are a fraction of the text, and each is read by one task, as it was written by one."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", compression).csv(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_silver(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """`partition_by` must be columns of few values, such as order_year; the rows go to their folder in one shuffle."""
    writer = df
    if partition_by:
        # REBALANCE splits a partition value that holds much of the data over several tasks
        writer = df.hint("rebalance", *partition_by)
    out = writer.write.mode(mode)
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def read_gold(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_gold(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """`fmt` may be any table format on the class path, for example "delta"."""
    df.write.format(fmt).mode("overwrite").save(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def save_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Replace a catalog table, its schema included."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_view(spark: SparkSession, name: str, select: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")
