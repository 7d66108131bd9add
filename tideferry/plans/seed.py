"""Default configuration rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tideferry.model import TRANSLATION_RULES, VALIDATION_CONFIG, ControlTable
from tideferry.operators.rewrite import DEFAULT_RULES
from tideferry.sources.control import ControlStore

# Default checks (fixed values); thresholds are fractions.
DEFAULT_CHECKS = (
    {"check_name": "Row Count Match", "check_type": "ROW_COUNT", "fail_threshold": 0.001},
    {"check_name": "Null Rate Match", "check_type": "NULL_RATE", "fail_threshold": 0.01},
    {"check_name": "Sample Checksum", "check_type": "CHECKSUM", "fail_threshold": 0.0},
)


def seed_configuration(store: ControlStore) -> None:
    """Append default rules and checks, leaving out those the store already has."""
    rules = [
        {
            "config_id": rule.rule_id,
            "config_type": rule.kind,
            "source_value": rule.source,
            "target_value": rule.target,
            "is_regex": rule.is_regex,
            "priority": rule.priority,
            "is_active": rule.is_active,
            "notes": rule.notes,
        }
        for rule in DEFAULT_RULES
    ]
    _append_absent(store, TRANSLATION_RULES, rules, ["config_type", "source_value"])
    _append_absent(store, VALIDATION_CONFIG, DEFAULT_CHECKS, ["check_type"])


def _append_absent(
    store: ControlStore, table: ControlTable, values: Sequence[Mapping], keys: list[str]
) -> None:
    known = {tuple(row) for row in store.read(table).select(*keys).collect()}
    fresh = [value for value in values if tuple(value[k] for k in keys) not in known]
    if fresh:
        store.append_values(table, fresh)
