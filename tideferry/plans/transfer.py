"""A transfer run: assess, translate, classify, load, validate, with an audit log.

Every step is a distributed job over whole tables. The driver holds names of
tables, counts and configuration, nothing else.
"""

from __future__ import annotations

import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tideferry.functions.frames import union_all
from tideferry.model import (
    CLASSIFICATION_LOG,
    COLUMN_SKETCHES,
    DEFINITION_STORE,
    REGISTRY,
    RUNS,
    SOURCE_INVENTORY,
    STEP_LOG,
    TRANSLATION_LOG,
    TRANSLATION_RULES,
    VALIDATION_CONFIG,
    VALIDATION_RESULTS,
)
from tideferry.operators.checksum import compare_sample, differences, sample_checksum
from tideferry.operators.classify import classify
from tideferry.operators.load import LoadResult, load_dataset, open_loaded
from tideferry.operators.reconcile import (
    CHECKSUM,
    NULL_RATE,
    NULL_RATE_TOLERANCE,
    ROW_COUNT,
    ROW_COUNT_TOLERANCE,
    configured_threshold,
    reconcile_null_rates,
    reconcile_row_counts,
    table_counts,
)
from tideferry.operators.registry import (
    inventory_of,
    latest_definition,
    pending_work,
    register_new,
)
from tideferry.operators.rewrite import rewrite, rules_from
from tideferry.operators.sketches import column_sketches
from tideferry.operators.state import matching
from tideferry.sources.control import ControlStore
from tideferry.sources.delimited import Dataset, dataset_for


@dataclass
class Step:
    """What a step reports when it ends."""

    rows: int | None = None
    tables: int | None = None
    failed: int | None = None


@dataclass
class BatchResult:
    loaded: list[LoadResult] = field(default_factory=list)
    failures: dict[str, str] = field(default_factory=dict)

    def summary(self) -> str:
        lines = [f"{len(self.loaded)} of {len(self.loaded) + len(self.failures)} tables arrived"]
        lines += [f"{table} did not: {message}" for table, message in self.failures.items()]
        return "\n".join(lines)


class Transfer:
    """One run over a control store. ``open`` starts a run; the constructor continues one."""

    def __init__(
        self,
        spark: SparkSession,
        store: ControlStore,
        run_id: str,
        datasets: Mapping[str, Dataset],
        target_root: str,
    ):
        self.spark = spark
        self.store = store
        self.run_id = run_id
        self.datasets = dict(datasets)
        self.target_root = target_root.rstrip("/")
        self._seq = self.log().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]

    @classmethod
    def open(
        cls,
        spark: SparkSession,
        store: ControlStore,
        run_name: str,
        datasets: Mapping[str, Dataset],
        target_root: str,
        triggered_by: str | None = None,
    ) -> "Transfer":
        run_id = str(uuid.uuid4())
        row = {"run_name": run_name, "status": "IN_PROGRESS", "triggered_by": triggered_by}
        store.append_values(RUNS, [row], run_id)
        return cls(spark, store, run_id, datasets, target_root)

    # -- audit -------------------------------------------------------------

    def log(self) -> DataFrame:
        return self.store.read(STEP_LOG, self.run_id)

    def registry(self) -> DataFrame:
        return self.store.current(REGISTRY, self.run_id)

    def results(self) -> DataFrame:
        return self.store.read(VALIDATION_RESULTS, self.run_id)

    def _entries(self, table: str, schema: str | None = None) -> list[Row]:
        """The run's registered tables of a name, of one schema or of all."""
        rows = self.registry().filter(F.upper("source_table") == table.upper())
        if schema is not None:
            rows = rows.filter(F.upper("source_schema") == schema.upper())
        return rows.orderBy("source_schema").collect()

    def _entry(self, table: str, schema: str | None = None) -> Row | None:
        """The one registered table of a name; None if there is none."""
        found = self._entries(table, schema)
        if len(found) > 1:
            schemas = ", ".join(row.source_schema for row in found)
            raise LookupError(f"{table} is in several schemas ({schemas}); name the schema")
        return found[0] if found else None

    def _note(self, phase: str, name: str, status: str, **values) -> None:
        self._seq += 1
        entry = {"phase": phase, "step_name": name, "status": status, "seq": self._seq}
        self.store.append_values(STEP_LOG, [entry | values], self.run_id)

    @contextmanager
    def step(self, phase: str, name: str, registry_id: str | None = None) -> Iterator[Step]:
        """Log STARTED, then SUCCESS with rows and seconds or FAILED with the message."""
        self._note(phase, name, "STARTED", registry_id=registry_id)
        begun, step = time.monotonic(), Step()
        try:
            yield step
        except Exception as error:
            self._note(
                phase,
                name,
                "FAILED",
                registry_id=registry_id,
                duration_secs=round(time.monotonic() - begun),
                error_message=str(error),
            )
            raise
        self._note(
            phase,
            name,
            "SUCCESS",
            registry_id=registry_id,
            rows_processed=step.rows,
            tables_processed=step.tables,
            tables_failed=step.failed,
            duration_secs=round(time.monotonic() - begun),
        )

    # -- phases ------------------------------------------------------------

    def assess(self, schema: str) -> int:
        """Register the schema's tables that this run does not know yet."""
        with self.step("ASSESSMENT", "ASSESS_SCHEMA") as step:
            before = self.registry()
            known = before.count()
            fresh = register_new(inventory_of(self.store.read(SOURCE_INVENTORY), schema), before)
            self.store.append(REGISTRY, fresh, self.run_id)
            step.rows = self.registry().count() - known
        return step.rows

    def translate(self, schema_prefix: str | None = None) -> int:
        """Rewrite the stored definitions of all registered tables."""
        with self.step("TRANSLATION", "TRANSLATE_DEFINITIONS") as step:
            rules = rules_from(self.store.read(TRANSLATION_RULES))
            names = ("source_schema", "source_table")
            definitions = matching(self.store.read(DEFINITION_STORE), self.registry(), names)
            rewritten = rewrite(
                definitions, "original_ddl", rules, schema_prefix, out="translated_ddl"
            )
            before = self.store.read(TRANSLATION_LOG, self.run_id).count()
            self.store.append(TRANSLATION_LOG, rewritten, self.run_id)
            translated = self.store.read(TRANSLATION_LOG, self.run_id)
            self.store.change(
                REGISTRY,
                matching(self.registry(), translated, names),
                self.run_id,
                status="TRANSLATED",
            )
            step.rows = translated.count() - before
        return step.rows

    def classify(self, queries: DataFrame, scorer: Callable | None = None) -> int:
        """Label every text of a query log."""
        with self.step("TRANSLATION", "CLASSIFY_QUERIES") as step:
            before = self.store.read(CLASSIFICATION_LOG, self.run_id).count()
            labelled = classify(queries.select("query_text"), scorer=scorer)
            self.store.append(CLASSIFICATION_LOG, labelled, self.run_id)
            step.rows = self.store.read(CLASSIFICATION_LOG, self.run_id).count() - before
        return step.rows

    def target_path(self, table: str, schema: str | None) -> str:
        return f"{self.target_root}/{(schema or '_').upper()}/{table.upper()}"

    def target(self, table: str, schema: str | None = None) -> DataFrame:
        """A table's rows: what this run loaded, else the newest load of any run."""
        entry = self._entry(table, schema)
        schema = entry.source_schema if entry else schema
        path = entry.target_path if entry and entry.target_path else self.target_path(table, schema)
        return open_loaded(self.spark, dataset_for(self.datasets, table, schema), path)

    def load_table(self, table: str, schema: str | None = None) -> LoadResult:
        """Replace one target table by its source files.

        Rows go to a new folder. When it is whole, the table's registry row is
        appended again with that folder; until then readers see the old rows.
        """
        found = self._entries(table, schema)
        with self.step("LOAD", "LOAD_TABLE", found[0].registry_id if len(found) == 1 else None) as step:
            entry = self._entry(table, schema)
            if entry is None or not self._is_translated(entry):
                raise LookupError(f"{table} has not been translated in this run")
            target = self.target_path(entry.source_table, entry.source_schema)
            rejects = f"{self.target_root}/_rejects/{entry.source_schema.upper()}/{table.upper()}"
            dataset = dataset_for(self.datasets, table, entry.source_schema)
            result = load_dataset(self.spark, dataset, target, rejects)
            rows = self.registry().filter(F.col("registry_id") == entry.registry_id)
            self.store.change(REGISTRY, rows, self.run_id, status="LOADED", target_path=result.path)
            step.rows = result.rows
        return result

    def _is_translated(self, entry: Row) -> bool:
        translated = self.store.read(TRANSLATION_LOG, self.run_id)
        own = (F.upper("source_table") == entry.source_table.upper()) & (F.upper("source_schema") == entry.source_schema.upper())
        return not latest_definition(translated.filter(own)).isEmpty()

    def load_batch(self) -> BatchResult:
        """Load every translated table in order of priority; one failure stops no other."""
        result = BatchResult()
        with self.step("LOAD", "LOAD_BATCH") as step:
            work = pending_work(self.registry()).select("priority", "source_table", "source_schema").collect()
            work = [(row.source_schema, row.source_table) for row in sorted(work, key=lambda row: (row.priority is None, row.priority or 0, row.source_table, row.source_schema))]
            names = Counter(table.upper() for _, table in work)
            for schema, table in work:
                try:
                    result.loaded.append(self.load_table(table, schema))
                except Exception as error:
                    name = table if names[table.upper()] == 1 else f"{schema}.{table}"
                    result.failures[name] = str(error)
            step.tables, step.failed = len(result.loaded), len(result.failures)
        return result

    def measure_distinct(self) -> int:
        """Keep sketches of the distinct values of every table this run loaded, by load; returns how many tables."""
        with self.step("ASSESSMENT", "MEASURE_DISTINCT") as step:
            loaded = self.registry().filter("target_path IS NOT NULL").collect()
            for entry in loaded:
                name = f"{entry.source_schema}.{entry.source_table}"
                rows = self.target(entry.source_table, entry.source_schema)
                self.store.append(COLUMN_SKETCHES, column_sketches({name: rows}, entry.target_path), self.run_id)
            step.tables = len(loaded)
        return step.tables

    def _record(self, checks: DataFrame, schema: str | None = None) -> None:
        """Append check results with the id of the table they belong to."""
        if "source_schema" not in checks.columns:
            checks = checks.withColumn("source_schema", F.lit(schema.upper() if schema else None).cast("string"))
        ids = self.registry().select("registry_id", F.upper("source_schema").alias("source_schema"), F.upper("source_table").alias("table_name"))
        self.store.append(VALIDATION_RESULTS, checks.join(ids, ["source_schema", "table_name"], "left"), self.run_id)

    def _source_counts(self, sources: Mapping[str, DataFrame], loaded: list[Row]) -> DataFrame:
        """Rows of given sources, each for the loaded table of its name or of its name with schema."""
        counts = []
        for name, rows in sources.items():
            exact = [row for row in loaded if f"{row.source_schema}.{row.source_table}".upper() == name.upper()]
            own = exact or [row for row in loaded if row.source_table.upper() == name.upper()]
            if len(own) > 1:
                raise LookupError(f"{name} is in several schemas; give its source a name with the schema")
            counts += [table_counts({row.source_table: rows}).withColumn("source_schema", F.lit(row.source_schema)) for row in own]
        empty = self.spark.createDataFrame([], "table_name STRING, n BIGINT, source_schema STRING")
        return union_all([empty, *counts])

    def validate_row_counts(
        self, sources: Mapping[str, DataFrame] | None = None, threshold=None
    ) -> int:
        """Check every loaded table, against ``sources`` or else the inventory's estimates."""
        with self.step("VALIDATION", "VALIDATE_ROW_COUNTS") as step:
            tables = self.registry().filter(F.col("status") == "LOADED")
            loaded = tables.collect()
            step.rows = len(loaded)
            if not loaded:
                return 0
            if sources is None:
                # The inventory also holds tables that this run did not load.
                known = self.store.read(SOURCE_INVENTORY)
                source_counts = matching(known, tables, ["source_schema", "source_table"]).select(
                    "source_schema", F.col("source_table").alias("table_name"), F.col("row_count_est").alias("n")
                )
            else:
                source_counts = self._source_counts(sources, loaded)
            if threshold is None:
                threshold = configured_threshold(
                    self.store.read(VALIDATION_CONFIG), ROW_COUNT, ROW_COUNT_TOLERANCE
                )
            target_counts = union_all(
                [
                    table_counts({row.source_table: self.target(row.source_table, row.source_schema)}).withColumn("source_schema", F.lit(row.source_schema))
                    for row in loaded
                ]
            )
            self._record(reconcile_row_counts(source_counts, target_counts, threshold))
            self.store.change(REGISTRY, tables, self.run_id, status="VALIDATED")
        return step.rows

    def _checked(self, table: str, schema: str | None) -> tuple[DataFrame, str | None, str | None]:
        """A target table, its schema and its registry id."""
        entry = self._entry(table, schema)
        schema = entry.source_schema if entry else schema
        return self.target(table, schema), schema, entry.registry_id if entry else None

    def validate_null_rates(self, table: str, source: DataFrame, schema: str | None = None) -> int:
        """Check every column of one target table against its source."""
        target, schema, registry_id = self._checked(table, schema)
        with self.step("VALIDATION", "VALIDATE_NULL_RATES", registry_id) as step:
            threshold = configured_threshold(
                self.store.read(VALIDATION_CONFIG), NULL_RATE, NULL_RATE_TOLERANCE
            )
            self._record(reconcile_null_rates(table, source, target, threshold), schema)
            step.rows = len(target.columns)
        return step.rows

    def validate_checksum(self, table: str, source: DataFrame, keys: Sequence[str], schema: str | None = None) -> DataFrame:
        """Compare a tenth of one table's keys; returns the keys that differ."""
        target, schema, registry_id = self._checked(table, schema)
        with self.step("VALIDATION", "VALIDATE_CHECKSUM", registry_id) as step:
            threshold = configured_threshold(self.store.read(VALIDATION_CONFIG), CHECKSUM, 0.0)
            compared = compare_sample(source, target, keys)
            self._record(sample_checksum(table, compared, threshold), schema)
            step.rows = 1
        return differences(compared)

    def close(self) -> None:
        """Mark the run as completed, and compact what it wrote."""
        run = self.store.current(RUNS, self.run_id)
        self.store.change(
            RUNS, run, self.run_id, status="COMPLETED", completed_at=F.localtimestamp()
        )
        self.store.compact(self.run_id)
