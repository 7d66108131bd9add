"""Pair the rows of a step log: every start with its own end, and the starts that have none.

Rows are sorted over all tasks by run, step and order, so that a start and its
end are neighbours, whatever lies between them in the log. What a row needs of
its neighbour in another part travels as one row per part. A run, or a step,
that holds most of the log is dealt to as many tasks as its rows fill.

A start belongs to the next row of its step if that is an end; another start
there means that the first one never ended. An end behind no start is not paired.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideferry.functions.frames import quoted
from tideferry.functions.times import elapsed_seconds
from tideferry.sources.shared import scratch_path

STARTED = "STARTED"
KEYS = ("run_id", "phase", "step_name")


def with_next(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows with ``_next``: keys and some values of the row behind in the order of keys and ``order``, null behind the last.

    Like ``lead`` over all rows, without a task that sees a whole group.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "in-order")
    placed = rows.orderBy(*[F.asc_nulls_first(quoted(c)) for c in (*keys, *order)]).withColumn("_id", F.monotonically_increasing_id())
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_id", 33))
    carried = F.struct(*[F.col(quoted(c)) for c in (*keys, *values)])
    heads = placed.groupBy("_part").agg(F.min_by(carried, "_id").alias("_head"))
    # A part's last row is followed by the first of the next part that has rows.
    heads = heads.select("_part", F.lead("_head").over(Window.orderBy("_part")).alias("_behind"))
    inside = F.lead(carried).over(Window.partitionBy("_part").orderBy("_id"))
    placed = placed.withColumn("_inside", inside)
    last = placed.groupBy("_part").agg(F.max("_id").alias("_id")).join(heads, "_part").select("_id", "_behind")
    return placed.join(last, "_id", "left").withColumn("_next", F.coalesce("_inside", "_behind")).drop("_id", "_part", "_inside", "_behind")


def _started(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every start with the row behind it, and whether that is its end."""
    followed = with_next(log, keys, ["seq"], ["seq", "status", "logged_at", "rows_processed"]).filter(F.col("status") == STARTED)
    own = F.col("_next").isNotNull() & (F.col("_next.status") != STARTED)
    for key in keys:
        own = own & F.col(f"_next.{quoted(key)}").eqNullSafe(F.col(quoted(key)))
    return followed.withColumn("_ended", F.coalesce(own, F.lit(False)))


def step_pairs(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Starts and their ends: status, rows and the seconds between them, rounded."""
    paired = _started(log, keys).filter("_ended")
    return paired.select(
        *[F.col(quoted(key)) for key in keys],
        F.col("seq").alias("started_seq"),
        F.col("_next.seq").alias("ended_seq"),
        F.col("_next.status").alias("status"),
        F.col("_next.rows_processed").alias("rows_processed"),
        F.col("logged_at").alias("started_at"),
        F.col("_next.logged_at").alias("ended_at"),
        elapsed_seconds(F.col("logged_at"), F.col("_next.logged_at")).alias("seconds"),
    )


def open_steps(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Starts that never ended."""
    return _started(log, keys).filter("NOT _ended").select(
        *[F.col(quoted(key)) for key in keys], F.col("seq").alias("started_seq"), F.col("logged_at").alias("started_at")
    )
