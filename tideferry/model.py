"""Control tables: schemas and the values a new row gets by default.

Control tables are append-only Parquet. A row that changes state is appended
again with a higher ``change_no``; the current row is the one with the highest
(see ``operators.state``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _uuid() -> Column:
    return F.expr("uuid()")


def _now() -> Column:
    return F.localtimestamp()


def _value(value) -> Callable[[], Column]:
    return lambda: F.lit(value)


@dataclass(frozen=True)
class ControlTable:
    name: str
    ddl: str
    key: str
    defaults: dict[str, Callable[[], Column]] = field(default_factory=dict)
    versioned: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


RUNS = ControlTable(
    "runs",
    "run_id STRING, run_name STRING, source_type STRING, target_type STRING, status STRING, "
    "triggered_by STRING, started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, notes STRING, "
    "change_no BIGINT",
    key="run_id",
    defaults={
        "run_id": _uuid,
        "status": _value("STARTED"),
        "started_at": _now,
        "change_no": _value(0),
    },
    versioned=True,
)

REGISTRY = ControlTable(
    "registry",
    "registry_id STRING, run_id STRING, source_schema STRING, source_table STRING, "
    "target_schema STRING, target_table STRING, row_count_est BIGINT, size_bytes_est BIGINT, "
    "priority BIGINT, status STRING, registered_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, "
    "change_no BIGINT, target_path STRING",
    key="registry_id",
    defaults={
        "registry_id": _uuid,
        "priority": _value(100),
        "status": _value("PENDING"),
        "registered_at": _now,
        "updated_at": _now,
        "change_no": _value(0),
    },
    versioned=True,
)

STEP_LOG = ControlTable(
    "step_log",
    "log_id STRING, run_id STRING, registry_id STRING, phase STRING, step_name STRING, "
    "status STRING, rows_processed BIGINT, tables_processed BIGINT, tables_failed BIGINT, "
    "duration_secs BIGINT, error_message STRING, logged_at TIMESTAMP_NTZ, seq BIGINT",
    key="log_id",
    defaults={"log_id": _uuid, "logged_at": _now},
)

TRANSLATION_RULES = ControlTable(
    "translation_rules",
    "config_id STRING, config_type STRING, source_value STRING, target_value STRING, "
    "is_regex BOOLEAN, priority BIGINT, is_active BOOLEAN, notes STRING",
    key="config_id",
    defaults={
        "config_id": _uuid,
        "is_regex": _value(False),
        "priority": _value(100),
        "is_active": _value(True),
    },
)

VALIDATION_CONFIG = ControlTable(
    "validation_config",
    "config_id STRING, check_name STRING, check_type STRING, is_active BOOLEAN, "
    "fail_threshold DOUBLE, notes STRING",
    key="config_id",
    defaults={
        "config_id": _uuid,
        "is_active": _value(True),
        "fail_threshold": _value(0.01),
    },
)

VALIDATION_RESULTS = ControlTable(
    "validation_results",
    "result_id STRING, run_id STRING, registry_id STRING, check_type STRING, source_schema STRING, table_name STRING, "
    "column_name STRING, check_name STRING, source_value DOUBLE, target_value DOUBLE, "
    "variance_pct DOUBLE, status STRING, note STRING, checked_at TIMESTAMP_NTZ",
    key="result_id",
    defaults={"result_id": _uuid, "checked_at": _now},
)

TRANSLATION_LOG = ControlTable(
    "translation_log",
    "translation_id STRING, run_id STRING, source_schema STRING, source_table STRING, "
    "original_ddl STRING, translated_ddl STRING, translated_at TIMESTAMP_NTZ",
    key="translation_id",
    defaults={"translation_id": _uuid, "translated_at": _now},
)

CLASSIFICATION_LOG = ControlTable(
    "classification_log",
    "classification_id STRING, run_id STRING, query_text STRING, query_category STRING, "
    "confidence STRING, classified_at TIMESTAMP_NTZ",
    key="classification_id",
    defaults={"classification_id": _uuid, "classified_at": _now},
)

SOURCE_INVENTORY = ControlTable(
    "source_inventory",
    "source_schema STRING, source_table STRING, row_count_est BIGINT, size_bytes_est BIGINT, "
    "has_distkey BOOLEAN, has_sortkey BOOLEAN, has_stored_procs BOOLEAN, registered_at TIMESTAMP_NTZ",
    key="source_table",
    defaults={"registered_at": _now},
)

DEFINITION_STORE = ControlTable(
    "definition_store",
    "source_schema STRING, source_table STRING, original_ddl STRING, created_at TIMESTAMP_NTZ",
    key="source_table",
    defaults={"created_at": _now},
)

COLUMN_SKETCHES = ControlTable(
    "column_sketches",
    "sketch_id STRING, run_id STRING, table_name STRING, column_name STRING, load_id STRING, row_count BIGINT, "
    "null_count BIGINT, sketch BINARY, measured_at TIMESTAMP_NTZ",
    key="sketch_id",
    defaults={"sketch_id": _uuid, "measured_at": _now},
)

ALL_TABLES = (
    RUNS,
    REGISTRY,
    STEP_LOG,
    TRANSLATION_RULES,
    VALIDATION_CONFIG,
    VALIDATION_RESULTS,
    TRANSLATION_LOG,
    CLASSIFICATION_LOG,
    SOURCE_INVENTORY,
    DEFINITION_STORE,
    COLUMN_SKETCHES,
)


def with_defaults(rows: DataFrame, table: ControlTable) -> DataFrame:
    """Shape ``rows`` to the table: fill absent or null columns, fix types and order."""
    have = set(rows.columns)
    columns = []
    for spec in table.schema.fields:
        default = table.defaults.get(spec.name)
        if spec.name in have and default:
            value = F.coalesce(F.col(spec.name), default())
        elif spec.name in have:
            value = F.col(spec.name)
        else:
            value = default() if default else F.lit(None)
        columns.append(value.cast(spec.dataType).alias(spec.name))
    return rows.select(*columns)
