"""Parquet tables of a data folder (``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming the columns keeps the scan's ReadSchema narrow.

    Catalyst prunes columns anyway, but selecting up front documents which
    columns each operator needs and keeps ``explain`` easy to read.
    """
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
