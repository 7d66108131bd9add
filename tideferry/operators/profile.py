"""Assess what is to be moved: columns, query log, rewriting effort."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideferry.functions.frames import computed_once, quoted, union_all
from tideferry.functions.text import bare_statement
from tideferry.operators.reconcile import COLUMNS_PER_SCAN
from tideferry.operators.statements import bare_words, tables_of

_COMPLEX = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)


_INVENTORY = "table_name STRING, position INT, column_name STRING, data_type STRING, is_complex BOOLEAN"


def column_inventory(
    tables: Mapping[str, DataFrame], estimate_distinct: bool = False
) -> DataFrame:
    """One row per column: type, whether it is complex, rows, nulls.

    One pass per table (per ``COLUMNS_PER_SCAN`` columns); distinct values are
    estimated by sketches in the same pass when asked for. The declared types
    come from the schemas and are as many as there are columns.
    """
    declared, profiles = [], []
    for table, rows in tables.items():
        fields = rows.schema.fields
        declared += [
            (table.upper(), i, f.name, f.dataType.simpleString(), isinstance(f.dataType, _COMPLEX))
            for i, f in enumerate(fields, 1)
        ]
        for start in range(0, len(fields), COLUMNS_PER_SCAN):
            names = rows.columns[start : start + COLUMNS_PER_SCAN]
            profile = _measured(rows, names, estimate_distinct)
            profiles.append(profile.withColumn("table_name", F.lit(table.upper())))
    types = tables[next(iter(tables))].sparkSession.createDataFrame(declared, _INVENTORY)
    measures = ["row_count", "null_count", *(["distinct_estimate"] if estimate_distinct else [])]
    return types.join(union_all(profiles), ["table_name", "column_name"]).select(
        *types.columns, *[F.col(f"_measures.{m}") for m in measures]
    )


def _measured(rows: DataFrame, names: list[str], estimate_distinct: bool) -> DataFrame:
    """(column_name, _measures) for some columns of a table, in one aggregation."""
    measured = []
    for name in names:
        column = quoted(name)
        parts = f"count(1) AS row_count, count(1) - count({column}) AS null_count"
        if estimate_distinct:
            hashable = not isinstance(rows.schema[name].dataType, (T.MapType, T.VariantType))
            estimate = f"approx_count_distinct({column})" if hashable else "CAST(NULL AS BIGINT)"
            parts += f", {estimate} AS distinct_estimate"
        measured.append(F.expr(f"struct({parts}) AS {column}"))
    columns = [quoted(name) for name in names]
    return rows.agg(*measured).unpivot([], columns, "column_name", "_measures")


def query_profile(queries: DataFrame, column: str = "query_text") -> DataFrame:
    """How often each table occurs in a query log, and with how many joins."""
    found = queries.select(computed_once([tables_of(F.col(column)).alias("found")]))
    names = F.array_union("found.reads", "found.writes")
    return (
        # The outer form: the plain one infers a filter that finds the names twice.
        found.select(F.col("found.joins").alias("joins"), F.explode_outer(names).alias("table_name"))
        .filter(F.col("table_name").isNotNull())
        .groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("queries"),
            F.count_if(F.col("joins") > 0).alias("queries_with_join"),
            F.max("joins").alias("most_joins"),
        )
    )


# What makes a statement need work (fixed values): constructs with a direct
# replacement, and constructs that have none.
MINOR_WORK = (
    r"(?i)\bgetdate\s*\(\s*\)|\bisnull\s*\(|\bsuper\b|\bhllsketch\b|\btimestamptz\b"
    r"|\bselect\s+top\s|\bencode\s+\w|\bdiststyle\b|\bdistkey\b|\bsortkey\b"
)
MAJOR_WORK = r"(?i)^\s*(?:copy|unload|vacuum|analyze)\b|\binterleaved\b|\bcreate\s+(?:or\s+replace\s+)?(?:procedure|function)\b"


def complexity_tier(queries: DataFrame, column: str = "query_text") -> DataFrame:
    """Translation effort: GREEN as is, YELLOW with replacements, RED rewrite.

    Two or more different kinds of replacement in one statement still are
    YELLOW; ``replacements`` counts them. Words in comments, strings and quoted
    names don't count.
    """
    words = queries.select("*", computed_once([bare_statement(bare_words(F.col(column))).alias("_words")]))
    counted = words.withColumn("replacements", F.coalesce(F.regexp_count("_words", F.lit(MINOR_WORK)), F.lit(0)))
    return counted.withColumn(
        "complexity_level",
        F.when(F.rlike("_words", F.lit(MAJOR_WORK)), F.lit("RED"))
        .when(F.col("replacements") > 0, F.lit("YELLOW"))
        .otherwise(F.lit("GREEN")),
    ).drop("_words")
