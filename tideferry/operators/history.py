"""Trim append-only history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def keep_history(spark: SparkSession, table: str, kept: Column, new_table: str) -> DataFrame:
    """Write the rows to keep into a new folder and return that table.

    The old folder stays as it is: a table cannot be replaced while it is
    being read, and readers of the old one are not disturbed.
    """
    rows = spark.read.parquet(table)
    rows.filter(kept).write.mode("errorifexists").parquet(new_table)
    return spark.read.schema(rows.schema).parquet(new_table)


def clear_history(spark: SparkSession, table: str, new_table: str) -> DataFrame:
    rows = spark.read.parquet(table)
    spark.createDataFrame([], rows.schema).write.mode("errorifexists").parquet(new_table)
    return spark.read.schema(rows.schema).parquet(new_table)
