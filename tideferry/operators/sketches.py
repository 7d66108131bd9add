"""Distinct values per column from sketches that are kept with every load and merged later.

A sketch has a few kilobytes however many values it has seen, and the sketch of
two loads is the union of theirs, so the distinct count of a table that is
loaded in parts needs no second reading of the parts before. Estimates are off
by ``ERROR`` on average, rarely by more than three times that; counts up to a
few hundred are exact or nearly so.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideferry.functions.frames import quoted, union_all
from tideferry.operators.reconcile import COLUMNS_PER_SCAN

# Two to this power is the number of a sketch's counters.
PRECISION = 14
ERROR = 1.04 / 2 ** (PRECISION / 2)

_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.StructType)
_NO_TEXT = (T.MapType, T.VariantType)


def _sketch(name: str, kind: T.DataType) -> str:
    """A column's sketch as SQL; values of other types are told apart by their text."""
    column = quoted(name)
    if isinstance(kind, _NO_TEXT):
        value = "CAST(NULL AS STRING)"
    elif isinstance(kind, _PLAIN):
        value = f"CAST({column} AS BIGINT)"
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        value = column
    elif isinstance(kind, _NESTED):
        value = f"to_json({column})"
    else:
        value = f"CAST({column} AS STRING)"
    return f"hll_sketch_agg({value}, {PRECISION})"


def column_sketches(tables: Mapping[str, DataFrame], load_id: str | None = None) -> DataFrame:
    """One row per table and column: rows, nulls, and the sketch of its values. One pass per table."""
    profiles = []
    for table, rows in tables.items():
        for start in range(0, len(rows.columns), COLUMNS_PER_SCAN):
            fields = rows.schema.fields[start : start + COLUMNS_PER_SCAN]
            measured = [
                F.expr(f"struct(count(1) AS row_count, count(1) - count({quoted(f.name)}) AS null_count, {_sketch(f.name, f.dataType)} AS sketch) AS {quoted(f.name)}")
                for f in fields
            ]
            profile = rows.agg(*measured).unpivot([], [quoted(f.name) for f in fields], "column_name", "_measures")
            profiles.append(profile.select(F.lit(table.upper()).alias("table_name"), "column_name", F.lit(load_id).cast("string").alias("load_id"), "_measures.*"))
    return union_all(profiles)


def merged(sketches: DataFrame) -> DataFrame:
    """The sketches of several loads as one per table and column."""
    return sketches.groupBy("table_name", "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def distinct_inventory(sketches: DataFrame) -> DataFrame:
    """Rows, nulls and estimated distinct values of every column over all its loads; null for maps and variants, which have no sketch."""
    estimate = F.hll_sketch_estimate("sketch")
    unseen = (estimate == 0) & (F.col("row_count") > F.col("null_count"))
    return merged(sketches).select("table_name", "column_name", "row_count", "null_count", F.when(~unseen, estimate).alias("distinct_estimate"))


def replaced_loads(sketches: DataFrame, order: str = "measured_at") -> DataFrame:
    """Of loads measured more than once, the newest sketches, so that a repeated load counts once."""
    newest = F.max_by(F.struct(*[F.col(c) for c in sketches.columns]), order)
    return sketches.groupBy("table_name", "column_name", "load_id").agg(newest.alias("_row")).select("_row.*")
