"""Load delimited datasets into typed Parquet tables.

Every load goes to a folder of its own, good and bad lines in one pass; when it
is whole, a pointer row is appended beside the loads, and readers follow the
newest. A load that fails leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tideferry.session import settings
from tideferry.sources.delimited import Dataset, parse_lines, read_lines
from tideferry.sources.shared import path_exists

# Below a load's folder, the good lines' rows and the bad lines.
GOOD, BAD = "bad=false", "bad=true"

_POINTERS = "_loads"
_POINTER = "load_id STRING, path STRING, number BIGINT, lines BIGINT, rows BIGINT, rejected BIGINT, loaded_at TIMESTAMP_NTZ"
_REJECT = "_line STRING, _source_file STRING, _reason STRING, _split_start BIGINT, _line_id BIGINT"


@dataclass(frozen=True)
class LoadResult:
    table: str
    path: str
    rejects_path: str | None
    lines: int
    rows: int
    rejected: int


def _read(spark: SparkSession, schema, path: str) -> DataFrame:
    """A folder's rows, none if there is no such folder."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def load_into(spark: SparkSession, dataset: Dataset, folder: str, reading: Mapping[str, str] | None = None) -> LoadResult:
    """Write a dataset's lines to a new folder: good ones as rows, bad ones as they are.

    One pass parses, counts and writes both; a task keeps two files open, so
    nothing is sorted to tell them apart. Every row keeps the split and the
    place it is from. Nothing is cached, so a lost executor costs its own tasks.
    ``reading`` holds session settings for the pass over the text alone: the
    rows it wrote are counted without them.
    """
    parsed = parse_lines(read_lines(spark, dataset.location), dataset)
    seen = Observation()
    counted = parsed.observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count("_reason").alias("rejected")
    )
    is_bad = F.col("_reason").isNotNull()
    rows = counted.withColumns({"bad": is_bad, "_line": F.when(is_bad, F.col("_line"))})
    with settings(spark, {**(reading or {}), "spark.sql.maxConcurrentOutputFileWriters": "4"}):
        rows.write.partitionBy("bad").parquet(folder)
    lines, bad = seen.get["lines"], seen.get["rejected"]
    good = f"{folder}/{GOOD}"
    return LoadResult(dataset.table, good, f"{folder}/{BAD}" if bad else None, lines, open_loaded(spark, dataset, good).count(), bad)


def load_dataset(
    spark: SparkSession, dataset: Dataset, target: str, rejects: str | None = None
) -> LoadResult:
    """Replace the target table by the good lines of a dataset, once all of them are there.

    Rejects, with their files and line numbers, replace those of the load
    before; they are made from what was written, without the text.
    """
    load_id = uuid.uuid4().hex
    folder = f"{target.rstrip('/')}/load={load_id}"
    result = load_into(spark, dataset, folder)
    if rejects:
        # Also without rejects, so that those of an earlier load do not stay.
        rejected_lines(spark, folder).write.mode("overwrite").parquet(rejects)
    number = _pointers(spark, target).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    row = (load_id, result.path, number, result.lines, result.rows, result.rejected)
    pointer = spark.createDataFrame([row], _POINTER.rpartition(", ")[0]).withColumn("loaded_at", F.localtimestamp())
    pointer.coalesce(1).write.mode("append").parquet(f"{target.rstrip('/')}/{_POINTERS}")
    return LoadResult(dataset.table, result.path, rejects if rejects and result.rejected else None, result.lines, result.rows, result.rejected)


def _pointers(spark: SparkSession, target: str) -> DataFrame:
    return _read(spark, _POINTER, f"{target.rstrip('/')}/{_POINTERS}")


def current_load(spark: SparkSession, target: str) -> str | None:
    """The folder of a target's newest whole load."""
    newest = _pointers(spark, target).agg(F.max(F.struct("number", "loaded_at", "path")).alias("newest")).first().newest
    return newest.path if newest else None


def open_loaded(spark: SparkSession, dataset: Dataset, target: str) -> DataFrame:
    """A target's rows by its newest load, or the rows of one load's folder."""
    if target.rstrip("/").endswith(GOOD):
        return _read(spark, dataset.schema, target)
    return _read(spark, dataset.schema, current_load(spark, target) or target)


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A load's bad lines as read, with the first reason, their file and their number in it.

    A line's number is its place in its split behind all lines of the file's
    splits before. The lines of a split are counted in what was written, by two
    columns that all rows have; what is summed up has one row per split.
    """
    bad = _read(spark, _REJECT, f"{folder}/{BAD}")
    places = "_source_file STRING, _split_start BIGINT, _line_id BIGINT"
    every = _read(spark, places, f"{folder}/{GOOD}").unionByName(bad.select("_source_file", "_split_start", "_line_id"))
    splits = every.groupBy("_source_file", "_split_start").agg(F.min("_line_id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("_source_file").orderBy("_split_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    number = F.col("before") + F.col("_line_id") - F.col("first") + 1
    return bad.join(splits, ["_source_file", "_split_start"]).select(
        F.col("_line").alias("line"), F.col("_source_file").alias("source_file"), F.col("_reason").alias("reason"), number.alias("line_number")
    )


def remove_old_loads(spark: SparkSession, target: str) -> int:
    """Delete the folders of all loads but the newest whole one; returns how many."""
    current = current_load(spark, target)
    root = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = 0
    for status in files.listStatus(root):
        path = status.getPath()
        if path.getName().startswith("load=") and (current is None or f"/{path.getName()}/" not in current):
            removed += files.delete(path, True)
    return removed


def batch_tally(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """Loaded and failed tables per batch, with the first and last failure message.

    All messages are in ``batch_failures``, as rows: joined into one text they
    would be as long as the batch has failures.
    """
    failed = ~F.col("loaded")
    message = F.when(failed, F.concat_ws(": ", "source_table", "error_message"))
    return outcomes.groupBy(*keys).agg(
        F.count_if("loaded").alias("tables_loaded"),
        F.count_if(failed).alias("tables_failed"),
        F.min(message).alias("first_failure"),
        F.max(message).alias("last_failure"),
    )


def batch_failures(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    return outcomes.filter(~F.col("loaded")).select(
        *keys, F.concat_ws(": ", "source_table", "error_message").alias("failure")
    )
