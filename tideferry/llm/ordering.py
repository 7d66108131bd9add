"""A table sorted over all its parts and numbered, so that a row's place among all rows needs no task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.sources.shared import scratch_path


def sorted_rows(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """The rows, written in order, with ``id``, which ascends with the order, and ``part``, which holds ids without gaps."""
    spark = rows.sparkSession
    path = scratch_path(spark, "sorted")
    numbered = rows.orderBy(*order).withColumn("id", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    return spark.read.schema(numbered.schema).parquet(path).withColumn("part", F.shiftright("id", 33))
