"""The control tables and four standing reports as temporary views, for SQL users."""

from __future__ import annotations

from tideferry.model import ALL_TABLES, REGISTRY, RUNS, STEP_LOG, VALIDATION_RESULTS
from tideferry.plans import reports
from tideferry.sources.control import ControlStore


def create_views(store: ControlStore, run_id: str | None = None) -> list[str]:
    """Register the views over a store, of one run or of all; returns their names."""
    registry, runs = store.current(REGISTRY, run_id), store.current(RUNS, run_id)
    views = {table.name: store.read(table) for table in ALL_TABLES}
    views |= {"registry": registry, "runs": runs}
    views |= {
        "v_migration_status": reports.status_view(registry, runs),
        "v_migration_summary": reports.status_summary(registry),
        "v_recent_activity": reports.recent_activity(store.read(STEP_LOG, run_id)),
        "v_validation_summary": reports.validation_view(
            store.read(VALIDATION_RESULTS, run_id), registry
        ),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    return sorted(views)


def drop_views(store: ControlStore, names: list[str]) -> None:
    for name in names:
        store.spark.catalog.dropTempView(name)
