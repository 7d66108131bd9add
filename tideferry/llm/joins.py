"""Joins with tables that are grouped by the join key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_index(rows: DataFrame, index: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with a table that has one row per ``key``, a number.

    A grouped table lies as the join wants it, so Spark would join it in the
    task that groups it, and a key with very many rows would stay in that task.
    A second key, made from the first, gives both sides an exchange directly
    below the join, which is where adaptive execution splits hot keys.
    """
    half = F.pmod(key, F.lit(2)).alias("_half")
    return rows.select("*", half).join(index.select("*", half), [key, "_half"], how).drop("_half")
