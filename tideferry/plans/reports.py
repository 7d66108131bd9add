"""Reports over control tables.

Every function takes DataFrames shaped like ``tideferry.model``. Reports that
people read for one run take an optional ``run_id``; without it they cover all
runs, by run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideferry.functions.numeric import pass_percent
from tideferry.functions.text import preview
from tideferry.functions.times import elapsed_seconds


def of_run(rows: DataFrame, run_id=None) -> DataFrame:
    return rows if run_id is None else rows.filter(F.col("run_id") == run_id)


def status_view(registry: DataFrame, runs: DataFrame, run_id=None) -> DataFrame:
    """Tables with the name and status of their run, in working order."""
    run = runs.select("run_id", "run_name", F.col("status").alias("run_status"))
    return (
        of_run(registry, run_id)
        .join(run, "run_id", "left")
        .orderBy(F.asc_nulls_last("priority"), F.asc_nulls_last("source_table"))
        .select(
            "run_name",
            "run_status",
            "source_schema",
            "source_table",
            "target_schema",
            "target_table",
            F.col("status").alias("table_status"),
            "row_count_est",
            "updated_at",
        )
    )


def status_summary(registry: DataFrame) -> DataFrame:
    return registry.groupBy("status").agg(
        F.count(F.lit(1)).alias("table_count"), F.sum("row_count_est").alias("total_rows_est")
    )


def recent_activity(log: DataFrame, rows: int = 50) -> DataFrame:
    """The newest log entries."""
    return (
        log.orderBy(F.desc_nulls_last("logged_at"), F.desc_nulls_last("seq"))
        .limit(rows)
        .select(
            "phase", "step_name", "status", "rows_processed", "duration_secs", "error_message", "logged_at"
        )
    )


def validation_view(results: DataFrame, registry: DataFrame) -> DataFrame:
    """Check results with the table they belong to; unassigned results stay."""
    tables = registry.select("registry_id", "source_table")
    return (
        results.join(tables, "registry_id", "left")
        .orderBy(F.asc_nulls_last("source_table"), F.asc_nulls_last("check_name"), "checked_at")
        .select(
            "source_table", "check_name", "status", "source_value", "target_value", "variance_pct", "checked_at"
        )
    )


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc_nulls_last("started_at"), F.desc_nulls_last("run_id")).limit(1)


def run_picker(runs: DataFrame) -> DataFrame:
    """Run ids with a display label, newest first."""
    label = F.concat("run_name", F.lit(" ("), F.col("run_id").cast("string"), F.lit(")"))
    return runs.orderBy(
        F.desc_nulls_last("started_at"), F.desc_nulls_last("run_id")
    ).select("run_id", label.alias("display"))


def registry_listing(registry: DataFrame, run_id=None) -> DataFrame:
    return (
        of_run(registry, run_id)
        .orderBy("source_table", "run_id", "registry_id")
        .select("run_id", "source_table", "target_table", "status")
    )


def run_kpis(registry: DataFrame, run_id=None) -> DataFrame:
    """Total, loaded and validated tables per run, in one pass."""
    return of_run(registry, run_id).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(F.col("status").isin("LOADED", "VALIDATED")).alias("loaded_tables"),
        F.count_if(F.col("status") == "VALIDATED").alias("validated_tables"),
    )


def pass_rate(results: DataFrame, run_id=None) -> DataFrame:
    """Percentage of checks passed; one row, 0 when there are none."""
    return of_run(results, run_id).agg(
        pass_percent(F.count_if(F.col("status") == "PASS"), F.count(F.lit(1))).alias("pass_rate")
    )


def run_overview(registry: DataFrame, results: DataFrame, run_id=None) -> DataFrame:
    """The tables of a run by state, and its validation pass rate (0 without checks)."""
    rates = of_run(results, run_id).groupBy("run_id").agg(
        pass_percent(F.count_if(F.col("status") == "PASS"), F.count(F.lit(1))).alias("pass_rate")
    )
    return (
        run_kpis(registry, run_id)
        .join(rates, "run_id", "left")
        .withColumn("pass_rate", F.coalesce("pass_rate", F.lit(0.0)))
    )


def definition_preview(translations: DataFrame, run_id=None, length: int = 120) -> DataFrame:
    """Starts of both texts; cut before the sort, so that whole texts are not moved."""
    return (
        of_run(translations, run_id)
        .select(
            "source_table",
            preview(F.col("original_ddl"), length).alias("original_preview"),
            preview(F.col("translated_ddl"), length).alias("translated_preview"),
            "translated_at",
            "translation_id",
        )
        .orderBy("source_table", "translated_at", "translation_id")
        .drop("translation_id")
    )


def query_preview(classified: DataFrame, length: int = 100, also: Sequence[str] = ()) -> DataFrame:
    """Starts of query texts by category; the text's hash keeps one category's rows apart in the sort."""
    return classified.select(
        *also,
        "query_category",
        "confidence",
        preview(F.col("query_text"), length).alias("query_preview"),
        "classified_at",
        F.xxhash64("query_text").alias("_text"),
    ).orderBy("query_category", "classified_at", *also, "_text").drop("_text")


def category_distribution(classified: DataFrame) -> DataFrame:
    return (
        classified.groupBy("query_category")
        .agg(F.count(F.lit(1)).alias("query_count"))
        .orderBy(F.desc("query_count"), "query_category")
    )


def confidence_distribution(classified: DataFrame) -> DataFrame:
    return (
        classified.groupBy("confidence").agg(F.count(F.lit(1)).alias("n")).orderBy("confidence")
    )


def log_kpis(log: DataFrame, run_id=None) -> DataFrame:
    """Steps, successes and failures per run, in one pass."""
    return of_run(log, run_id).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_steps"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful_steps"),
        F.count_if(F.col("status") == "FAILED").alias("failed_steps"),
    )


def rows_processed_total(log: DataFrame, run_id=None) -> DataFrame:
    return of_run(log, run_id).agg(
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows")
    )


def log_phases(log: DataFrame, run_id=None) -> DataFrame:
    return of_run(log, run_id).select("phase").distinct().orderBy("phase")


def _chronological(log: DataFrame) -> DataFrame:
    return log.orderBy("run_id", F.asc_nulls_last("logged_at"), F.asc_nulls_last("seq"))


_LOG_COLUMNS = ("run_id", "seq", "phase", "step_name", "status", "rows_processed", "logged_at", "error_message")


def audit_trail(log: DataFrame, run_id=None, phase: str | None = None) -> DataFrame:
    """Every step in order of time."""
    rows = of_run(log, run_id)
    if phase is not None:
        rows = rows.filter(F.col("phase") == phase)
    return _chronological(rows).select(*_LOG_COLUMNS)


def log_by_phase(log: DataFrame, phases: Sequence[str], run_id=None) -> DataFrame:
    return _chronological(of_run(log, run_id).filter(F.col("phase").isin(*phases))).select(
        *_LOG_COLUMNS
    )


def failed_steps(log: DataFrame, run_id=None) -> DataFrame:
    return _chronological(of_run(log, run_id).filter(F.col("status") == "FAILED")).select(
        "run_id", "seq", "phase", "step_name", "error_message"
    )


def step_durations(log: DataFrame, run_id=None) -> DataFrame:
    """Seconds from the first start to the last end, per run."""
    started = F.min(F.when(F.col("status") == "STARTED", F.col("logged_at")))
    ended = F.max(F.when(F.col("status") != "STARTED", F.col("logged_at")))
    return (
        of_run(log, run_id)
        .groupBy("run_id")
        .agg(started.alias("started_at"), ended.alias("ended_at"))
        .select("run_id", elapsed_seconds(F.col("started_at"), F.col("ended_at")).alias("duration_secs"))
    )
