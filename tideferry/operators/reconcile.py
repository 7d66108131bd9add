"""Compare source and target: row counts per table, null rates per column.

Each side of each table is read once, whatever its number of columns, and
reduced to one row per scan task before anything is shuffled. What is joined
afterwards has one row per table or per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.functions.frames import quoted, union_all
from tideferry.functions.numeric import percent, round4, variance_percent
from tideferry.functions.text import part

ROW_COUNT = "ROW_COUNT"
NULL_RATE = "NULL_RATE"
CHECKSUM = "CHECKSUM"

# Tolerances when no configuration row says otherwise (fixed values), in
# percent of the source rows and in percentage points.
ROW_COUNT_TOLERANCE = 5.0
NULL_RATE_TOLERANCE = 1.0

# Columns profiled per scan: an aggregate of more makes generated code too long
# to compile. Wider tables are read once per chunk, each scan its own columns.
COLUMNS_PER_SCAN = 400


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row (table_name, n) per table, as a union of plain counts."""
    return union_all(
        [
            rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, rows in tables.items()
        ]
    )


def configured_threshold(config: DataFrame, check_type: str, default: float) -> Column:
    """Tolerance in percent from the first active row of a check type, else ``default``.

    Configuration holds fractions (0.01 is one percent); this is the one place
    that converts. The result is a scalar subquery, so no extra job runs.
    """
    first = config.filter(F.col("is_active") & (F.col("check_type") == check_type)).agg(
        F.min_by("fail_threshold", "config_id").alias("fraction")
    )
    return first.select(
        F.coalesce(F.col("fraction") * F.lit(100.0), F.lit(float(default))).alias("threshold")
    ).scalar()


def verdict(distance: Column, threshold: float | Column) -> Column:
    bound = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(distance > bound, F.lit("FAIL")).otherwise(F.lit("PASS"))


def reconcile_row_counts(
    source_counts: DataFrame,
    target_counts: DataFrame,
    threshold: float | Column = ROW_COUNT_TOLERANCE,
) -> DataFrame:
    """One check per table of either side, from two frames (table_name, n).

    Names are compared without regard to case. Where both frames have a column
    ``source_schema``, tables are told apart by it as well, and the checks carry
    it. A table the source does not know counts as 0 there, varies by 0 and is
    noted; one that never arrived counts as 0 in the target and is noted as well.
    """
    by_schema = "source_schema" in source_counts.columns and "source_schema" in target_counts.columns
    keys = ["source_schema", "table_name"] if by_schema else ["table_name"]
    names = [F.upper(key).alias(key) for key in keys]
    target = target_counts.select(*names, F.col("n").alias("t"))
    source = source_counts.groupBy(*names).agg(F.min("n").alias("s"))
    rows = target.join(source, keys, "full").select(
        *keys,
        F.col("s").isNull().alias("unknown"),
        F.col("t").isNull().alias("absent"),
        F.coalesce("s", F.lit(0)).cast("double").alias("source_value"),
        F.coalesce("t", F.lit(0)).cast("double").alias("target_value"),
    )
    variance = variance_percent(F.col("source_value"), F.col("target_value"))
    return rows.select(
        F.lit(ROW_COUNT).alias("check_type"),
        *keys,
        F.lit(None).cast("string").alias("column_name"),
        F.concat(F.lit(f"{ROW_COUNT}:"), "table_name").alias("check_name"),
        "source_value",
        "target_value",
        round4(variance).alias("variance_pct"),
        verdict(variance, threshold).alias("status"),
        F.when(F.col("unknown") | (F.col("source_value") == 0), F.lit("NO_SOURCE"))
        .when(F.col("absent"), F.lit("NO_TARGET"))
        .alias("note"),
    )


def null_rates(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_rate) per column, the rate in percent."""
    names = list(columns or rows.columns)
    profiles = []
    for start in range(0, len(names), COLUMNS_PER_SCAN):
        chunk = [quoted(name) for name in names[start : start + COLUMNS_PER_SCAN]]
        filled = rows.agg(
            F.count(F.lit(1)).alias("_rows"), *[F.expr(f"count({c}) AS {c}") for c in chunk]
        )
        profiles.append(filled.unpivot("_rows", chunk, "column_name", "_filled"))
    rate = F.coalesce(percent(F.col("_rows") - F.col("_filled"), F.col("_rows")), F.lit(0.0))
    return union_all(profiles).select("column_name", round4(rate).alias("null_rate"))


def reconcile_null_rates(
    table: str,
    source: DataFrame,
    target: DataFrame,
    threshold: float | Column = NULL_RATE_TOLERANCE,
) -> DataFrame:
    """One check per target column; fails when the rates lie too far apart.

    A column the source does not have fails too, and is noted.
    """
    known = {name.upper(): name for name in source.columns}
    shared = [known[name.upper()] for name in target.columns if name.upper() in known]
    upper = F.upper("column_name")
    before = null_rates(source, shared) if shared else null_rates(target).limit(0)
    before = before.select(upper.alias("_column"), F.col("null_rate").alias("source_value"))
    after = null_rates(target).withColumn("_column", upper)
    distance = round4(F.abs(F.col("null_rate") - F.col("source_value")))
    return after.join(before, "_column", "left").select(
        F.lit(NULL_RATE).alias("check_type"),
        F.lit(table.upper()).alias("table_name"),
        "column_name",
        F.concat(F.lit(f"{NULL_RATE}:{table.upper()}."), "column_name").alias("check_name"),
        "source_value",
        F.col("null_rate").alias("target_value"),
        distance.alias("variance_pct"),
        F.when(F.col("source_value").isNull(), F.lit("FAIL")).otherwise(verdict(distance, threshold)).alias("status"),
        F.when(F.col("source_value").isNull(), F.lit("NO_SOURCE_COLUMN")).alias("note"),
    )


def reconcile_null_rates_of(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]],
    threshold: float | Column = NULL_RATE_TOLERANCE,
) -> DataFrame:
    return union_all(
        [
            reconcile_null_rates(table, source, target, threshold)
            for table, (source, target) in pairs.items()
        ]
    )


# -- listings over check results ------------------------------------------


def severity(status: Column) -> Column:
    """Sort key that puts failures first (the names alone sort PASS above FAIL)."""
    return F.when(status == "FAIL", 0).when(status == "WARNING", 1).otherwise(2)


def ranked(results: DataFrame) -> DataFrame:
    return results.orderBy(severity(F.col("status")), F.asc_nulls_last("check_name"))


def table_level(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("check_name").like("%.%"))


def column_level(results: DataFrame) -> DataFrame:
    return results.filter(F.col("check_name").like("%.%"))


def row_count_checks(results: DataFrame) -> DataFrame:
    """Row-count checks by table, the numbers as text."""
    return (
        results.filter(F.col("check_name").like(f"{ROW_COUNT}:%"))
        .select(
            part(F.col("check_name"), ":", 2).alias("table_name"),
            F.col("source_value").cast("bigint").cast("string").alias("source_rows"),
            F.col("target_value").cast("bigint").cast("string").alias("target_rows"),
            "variance_pct",
            "status",
        )
        .orderBy("table_name")
    )


def null_rate_tables(results: DataFrame) -> DataFrame:
    return (
        results.filter(F.col("check_name").like(f"{NULL_RATE}:%"))
        .select("table_name")
        .distinct()
        .orderBy("table_name")
    )


def null_rate_columns(results: DataFrame, table: str | None = None) -> DataFrame:
    """Columns with null checks, widest distance first; of one table or of all."""
    checks = results.filter(F.col("check_name").like(f"{NULL_RATE}:%"))
    if table is not None:
        checks = checks.filter(F.col("table_name") == table)
    return checks.select(
        "table_name",
        "column_name",
        F.col("target_value").alias("null_rate"),
        "variance_pct",
        "status",
    ).orderBy(F.desc_nulls_last("variance_pct"), "table_name", "column_name")


def pass_fail(results: DataFrame) -> DataFrame:
    return results.groupBy("check_type").agg(
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    )
