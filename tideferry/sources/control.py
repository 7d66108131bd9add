"""Append-only control tables in one folder.

Layout: ``<root>/<table>/run_id=<id>/`` for tables that belong to a run, so
two runs never write into the same folder and a report on one run prunes to
its files; plain ``<root>/<table>/`` for configuration.

A run leaves many small files. Compaction writes the current rows of each of
its tables to ``<root>/_snapshots/<table>/run_id=<id>/<number>/`` together with
the names of the files they are from; reads of that run then take the newest
whole snapshot and the files that came later. Nothing is deleted or moved.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideferry.model import ALL_TABLES, ControlTable, with_defaults
from tideferry.operators.state import advance, latest_rows
from tideferry.sources.shared import path_exists


# Files of a snapshot have about this size.
SNAPSHOT_BYTES = 32 << 20


class ControlStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._covered: dict[str, set[str]] = {}

    def create(self) -> "ControlStore":
        """Create the tables that are missing; existing ones are left alone."""
        for table in ALL_TABLES:
            empty = self.spark.createDataFrame([], table.schema)
            empty.write.mode("ignore").parquet(self._path(table))
        return self

    def _path(self, table: ControlTable, run_id: str | None = None) -> str:
        folder = f"{self.root}/{table.name}"
        if run_id is None:
            return folder
        if not re.fullmatch(r"[\w.-]+", run_id):
            raise ValueError(f"run id unfit for a folder name: {run_id!r}")
        return f"{folder}/run_id={run_id}"

    def read(self, table: ControlTable, run_id: str | None = None) -> DataFrame:
        """All rows of a table; with ``run_id`` only that run's files are listed and read."""
        if run_id is not None and not table.versioned and self._snapshot(table, run_id) is not None:
            return self._since(table, run_id)
        return self._all(table, run_id)

    def _all(self, table: ControlTable, run_id: str | None) -> DataFrame:
        names, reader = table.schema.names, self.spark.read.schema(table.schema)
        if run_id is None:
            return reader.parquet(self._path(table)).select(*names)
        if not path_exists(self.spark, self._path(table, run_id)):
            return self.spark.createDataFrame([], table.schema)
        rows = reader.option("basePath", self._path(table)).parquet(self._path(table, run_id))
        return rows.select(*names)

    def current(self, table: ControlTable, run_id: str | None = None) -> DataFrame:
        """The table with only the newest version of each row."""
        if not table.versioned:
            return self.read(table, run_id)
        compacted = run_id is not None and self._snapshot(table, run_id) is not None
        rows = self._since(table, run_id) if compacted else self._all(table, run_id)
        return latest_rows(rows, [table.key], ["change_no", *_tie_breaks(table)])

    # -- snapshots -----------------------------------------------------------

    def _names(self, folder: str, files: bool) -> dict[str, int]:
        """Names in a folder with their sizes, of files or of folders; none if there is no such folder."""
        if not path_exists(self.spark, folder):
            return {}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        listed = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        named = {status.getPath().getName(): status.getLen() for status in listed if status.isFile() == files}
        return {name: size for name, size in named.items() if not name.startswith(("_", "."))}

    def _snapshots(self, table: ControlTable, run_id: str) -> str:
        return f"{self.root}/_snapshots/{table.name}/run_id={run_id}"

    def _snapshot(self, table: ControlTable, run_id: str) -> int | None:
        """The number of a run's newest snapshot that is whole: its list of files is written last."""
        folder = self._snapshots(table, run_id)
        whole = [int(name) for name in self._names(folder, files=False) if path_exists(self.spark, f"{folder}/{name}/covered/_SUCCESS")]
        return max(whole, default=None)

    def _since(self, table: ControlTable, run_id: str) -> DataFrame:
        """The rows of the newest snapshot and of the files that came after it."""
        folder = f"{self._snapshots(table, run_id)}/{self._snapshot(table, run_id)}"
        if folder not in self._covered:
            self._covered[folder] = {row.name for row in self.spark.read.schema("name STRING").parquet(f"{folder}/covered").collect()}
        own = self._path(table, run_id)
        later = sorted(set(self._names(own, files=True)) - self._covered[folder])
        kept = T.StructType([field for field in table.schema.fields if field.name != "run_id"])
        rows = self.spark.read.schema(kept).parquet(f"{folder}/rows", *[f"{own}/{name}" for name in later])
        return rows.withColumn("run_id", F.lit(run_id)).select(*table.schema.names)

    def compact(self, run_id: str) -> list[str]:
        """Snapshot the tables of a run that have files; returns their names."""
        done = []
        for table in ALL_TABLES:
            names = self._names(self._path(table, run_id), files=True)
            if not names:
                continue
            number = (self._snapshot(table, run_id) or 0) + 1
            folder = f"{self._snapshots(table, run_id)}/{number}"
            files = max(1, sum(names.values()) // SNAPSHOT_BYTES)
            rows = self.current(table, run_id).drop("run_id")
            # Also what a snapshot that was broken off left there goes.
            rows.repartition(files).write.mode("overwrite").parquet(f"{folder}/rows")
            covered = self.spark.createDataFrame([(name,) for name in names], "name STRING")
            covered.coalesce(1).write.mode("overwrite").parquet(f"{folder}/covered")
            done.append(table.name)
        return done

    def append(self, table: ControlTable, rows: DataFrame, run_id: str | None = None) -> None:
        """Append rows; with ``run_id`` they go to that run's own folder."""
        if run_id is None:
            with_defaults(rows, table).write.mode("append").parquet(self._path(table))
            return
        rows = with_defaults(rows.withColumn("run_id", F.lit(run_id)), table).drop("run_id")
        rows.write.mode("append").parquet(self._path(table, run_id))

    def append_values(
        self, table: ControlTable, values: Iterable[Mapping], run_id: str | None = None
    ) -> None:
        """Append a few literal rows (configuration, log entries), as one file."""
        names = table.schema.names
        rows = [tuple(value.get(name) for name in names) for value in values]
        frame = self.spark.createDataFrame(rows, table.schema).coalesce(1)
        self.append(table, frame, run_id)

    def change(self, table: ControlTable, rows: DataFrame, run_id: str, **values) -> None:
        """Append a new version of current ``rows`` with some values changed."""
        if "updated_at" in table.schema.names:
            values["updated_at"] = F.localtimestamp()
        self.append(table, advance(rows, **values), run_id)


def _tie_breaks(table: ControlTable) -> list[str]:
    return [name for name in ("updated_at",) if name in table.schema.names]
