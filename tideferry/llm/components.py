"""Connected components of an edge list, by alternating large and small stars.

Every round is two groupings and joins over the edges, written as a table, so
that neither lineage nor anything the driver holds grows with the rounds. A
node with very many neighbours makes a long join side; the join with its
smallest neighbour has an exchange of its own, so adaptive execution can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideferry.llm.joins import with_index
from tideferry.sources.shared import scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour to the smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return with_index(both.filter("b > a"), least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    inner = with_index(edges, least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return inner.unionByName(least.withColumnRenamed("least", "b"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for all nodes of the edges ``a``, ``b``."""
    spark = edges.sparkSession
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        path = scratch_path(spark, "edges")
        edges.write.parquet(path)
        edges = spark.read.parquet(path)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        # Done when a round changes nothing: then every edge leads to a root.
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        edges = _small_star(_large_star(edges).distinct()).distinct()
