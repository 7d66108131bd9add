"""Running totals over a sorted table, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideferry.sources.shared import scratch_path


def running(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """A table of ``key`` and ``begin``, the sum of ``size`` over all rows before it.

    Rows are sorted into parts and numbered in order; each part then starts
    where the parts before it end. Only the parts' sums meet in one place.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "order")
    rows.orderBy(*order).select("key", F.col(size).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("id")).write.parquet(path)
    rows = spark.read.schema("key bigint, size bigint, id bigint").parquet(path).withColumn("part", F.shiftright("id", 33))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("size").alias("sum")).select("part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(parts, "part")
    path = scratch_path(spark, "places")
    rows.select("key", (F.col("before") + F.col("within")).alias("begin")).write.parquet(path)
    return spark.read.schema("key bigint, begin bigint").parquet(path)
