"""Bring a table up to its source: inserted, updated and deleted rows, by buckets of keys.

The table lies in one folder per bucket, a bucket being a hash of the key.
Beside it lie the digests its source had when it was last merged, one row per
key. Three digests of a key, of source, table and last time, tell what happened
to it: whether the source changed it, or the table drifted by itself. Digests
of equal rows add up, so a key may have any number of rows, and only keys and
digests are shuffled, combined first.

Only buckets that hold a key to be written are rewritten, by overwriting their
folders; all other files stay as they are. A merge that breaks off is repaired by the
next one, as it compares what is there.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideferry.functions.frames import quoted
from tideferry.sources.shared import path_exists

BUCKETS = 64
_BUCKET = "_bucket"

# A row's digest: the halves of two hashes, whose sums can't overflow below 2**31 rows of a key.
_SEEDS = (11, 12)
_HALVES = [f"_half{seed}{side}" for seed in _SEEDS for side in ("low", "high")]
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)

INSERTED, UPDATED, DELETED, DRIFTED = "INSERTED", "UPDATED", "DELETED", "DRIFTED"


@dataclass(frozen=True)
class MergeResult:
    inserted: int
    updated: int
    deleted: int
    drifted: int
    buckets: tuple[int, ...]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A key's bucket; the null key has one as well."""
    return F.pmod(F.xxhash64(*[F.col(quoted(k)) for k in keys]), F.lit(buckets)).cast("int")


def conformed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in the schema's columns and types; a value that does not convert raises."""
    return rows.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def digests(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and summed digests of every key."""
    values = []
    for field in rows.schema.fields:
        value = F.col(quoted(field.name))
        nested = isinstance(field.dataType, _NESTED)
        values += [F.to_json(value, {"ignoreNullFields": "false"}) if nested else value, value.isNull()]
    halves = []
    for seed in _SEEDS:
        whole = F.xxhash64(F.lit(seed), *values)
        halves += [whole.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(whole, 32)]
    hashed = rows.select(*map(quoted, keys), *[half.alias(name) for half, name in zip(halves, _HALVES)])
    return hashed.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(name).alias(name) for name in _HALVES])


def _changes(source: DataFrame, table: DataFrame, last: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that differ anywhere, from the digests of three sides: what happened, and whether the table must be written."""
    sides = []
    for name, side in (("source", source), ("table", table), ("last", last)):
        counts = [F.when(F.lit(name == other), F.col("_rows")).otherwise(0).alias(f"_{other}") for other in ("source", "table", "last")]
        # The source's digest less the table's, and less that of last time.
        against = [(F.col(half) * sign).alias(f"{other}{half}") for other in ("table", "last") for half in _HALVES for sign in (1 if name == "source" else -1 if name == other else 0,)]
        sides.append(side.select(*map(quoted, keys), *counts, *against))
    both = sides[0].unionByName(sides[1]).unionByName(sides[2])
    summed = both.groupBy(*map(quoted, keys)).agg(*[F.sum(name).alias(name) for name in both.columns if name not in keys])

    def differs(other: str) -> Column:
        found = F.col("_source") != F.col(f"_{other}")
        return functools.reduce(lambda a, half: a | (F.col(f"{other}{half}") != 0), _HALVES, found)

    change = (
        F.when((F.col("_last") == 0) & (F.col("_source") > 0), INSERTED)
        .when((F.col("_source") == 0) & (F.col("_last") > 0), DELETED)
        .when(differs("last"), UPDATED)
        .when(differs("table"), DRIFTED)
    )
    summed = summed.select(*map(quoted, keys), change.alias("change"), differs("table").alias("written"))
    return summed.filter(F.col("change").isNotNull())


def row_changes(source: DataFrame, table: DataFrame, keys: Sequence[str], last: DataFrame | None = None) -> DataFrame:
    """Every key whose rows differ: INSERTED, UPDATED or DELETED in the source since ``last``, or DRIFTED in the table.

    ``last`` is the source as it was merged before, else the table stands for
    it. ``written`` tells whether the table has to be changed. A null key is a key.
    """
    source, table = conformed(source, table.schema), digests(table, keys)
    before = table if last is None else digests(conformed(last, source.schema), keys)
    return _changes(digests(source, keys), table, before, keys)


class MergedTable:
    """A table in bucket folders, with the digests of its source beside it."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.schema, self.buckets = spark, path.rstrip("/"), list(keys), schema, buckets
        kept = [schema[k] for k in keys] + [T.StructField(name, T.LongType()) for name in ("_rows", *_HALVES)]
        self._digest_schema = T.StructType(kept)

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        bucketed = T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])
        if path_exists(self.spark, f"{self.path}/{part}"):
            return self.spark.read.schema(bucketed).parquet(f"{self.path}/{part}")
        return self.spark.createDataFrame([], bucketed)

    def rows(self) -> DataFrame:
        return self._read("rows", self.schema).drop(_BUCKET)

    def changes(self, source: DataFrame) -> DataFrame:
        """What a merge of ``source`` would do, by key."""
        last = self._read("digests", self._digest_schema).drop(_BUCKET)
        return _changes(digests(conformed(source, self.schema), self.keys), digests(self.rows(), self.keys), last, self.keys)

    def merge(self, source: DataFrame) -> MergeResult:
        """Make the table equal to ``source``; only touched buckets are written."""
        source = conformed(source, self.schema)
        bucket = bucket_of(self.keys, self.buckets)
        changed = self.changes(source).groupBy(bucket.alias(_BUCKET), "change").agg(F.count(F.lit(1)).alias("n"), F.max("written").alias("written"))
        found = changed.collect()  # at most four rows per bucket
        counts = {kind: sum(row.n for row in found if row.change == kind) for kind in (INSERTED, UPDATED, DELETED, DRIFTED)}
        written = sorted({row[_BUCKET] for row in found if row.written})
        noted = sorted({row[_BUCKET] for row in found})
        if written:
            self._overwrite("rows", source, written)
        if noted:
            self._overwrite("digests", digests(source.filter(bucket.isin(noted)), self.keys), noted)
        return MergeResult(counts[INSERTED], counts[UPDATED], counts[DELETED], counts[DRIFTED], tuple(written))

    def _overwrite(self, part: str, rows: DataFrame, buckets: list[int]) -> None:
        """Replace some buckets' folders; those that get no rows go."""
        path = f"{self.path}/{part}"
        rows = rows.withColumn(_BUCKET, bucket_of(self.keys, self.buckets)).filter(F.col(_BUCKET).isin(buckets))
        # Small buckets share a task, a large one is dealt to several.
        rows = rows.hint("rebalance", _BUCKET)
        kept = Observation()
        rows = rows.observe(kept, F.collect_set(_BUCKET).alias("buckets"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
        for bucket in set(buckets) - set(kept.get["buckets"]):
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_BUCKET}={bucket}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
