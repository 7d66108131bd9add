"""Catalogue source tables into a run's registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideferry.operators.state import latest_rows


def inventory_of(inventory: DataFrame, schema: str) -> DataFrame:
    """Inventory rows of one schema, whatever the letter case."""
    return inventory.filter(F.upper("source_schema") == schema.upper())


def register_new(inventory: DataFrame, registry: DataFrame, target_schema: str = "TARGET") -> DataFrame:
    """Registry rows for inventory tables that the registry does not hold yet.

    Names compare case-insensitively, against the registry and among the new
    rows themselves. Both sides are reduced to one row per name before they
    meet; the join and both reductions share one hash partitioning.
    """
    schema, table = F.upper("source_schema"), F.upper("source_table")
    known = registry.select(schema.alias("_schema"), table.alias("_table")).distinct()
    first = (
        inventory.groupBy(schema.alias("_schema"), table.alias("_table"))
        .agg(
            F.min(
                F.struct("source_table", "source_schema", "row_count_est", "size_bytes_est")
            ).alias("_row")
        )
        .select("_schema", "_table", "_row.*")
    )
    fresh = first.join(known, ["_schema", "_table"], "left_anti")
    return fresh.select(
        "source_schema",
        "source_table",
        F.lit(target_schema).alias("target_schema"),
        F.upper("source_table").alias("target_table"),
        "row_count_est",
        "size_bytes_est",
        F.lit("PENDING").alias("status"),
    )


def pending_work(registry: DataFrame, status: str = "TRANSLATED") -> DataFrame:
    """Tables in a state, in the order they are to be worked on."""
    return registry.filter(F.col("status") == status).orderBy(
        F.asc_nulls_last("priority"), F.asc_nulls_last("source_table")
    )


def latest_definition(translations: DataFrame) -> DataFrame:
    """Newest translated text per table name, ignoring letter case."""
    return latest_rows(
        translations, [F.upper("source_table")], ["translated_at", "translation_id"]
    )
