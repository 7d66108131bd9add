"""Merging a table with its source: what changed, what is written, what stays untouched."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tideferry.operators.incremental import new_rows
from tideferry.operators.merge import MergedTable, bucket_of, row_changes

SCHEMA = "k bigint, v string, `a.b` int"
OLD = [(1, "same", 1), (2, "old", 1), (3, "gone", 1), (None, "null", 1), (5, "twice", 1), (5, "twice", 1), (6, None, None), (8, "left", 2)]
NEW = [(1, "same", 1), (2, "new", 1), (4, "come", 1), (None, "null", 2), (5, "twice", 1), (5, "other", 1), (6, None, None), (7, "", None), (8, "left", 2)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def listed(rows):
    return sorted((tuple(row) for row in rows.collect()), key=str)


def files(path):
    return {os.path.join(root, name): os.stat(os.path.join(root, name)).st_mtime_ns for root, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    return MergedTable(spark, str(tmp_path / "table"), ["k"], frame(spark, []).schema, 8)


def test_changes_without_a_last_time(spark):
    found = {row.k: (row.change, row.written) for row in row_changes(frame(spark, NEW), frame(spark, OLD), ["k"]).collect()}
    assert found == {2: ("UPDATED", True), 3: ("DELETED", True), 4: ("INSERTED", True), 7: ("INSERTED", True), 5: ("UPDATED", True), None: ("UPDATED", True)}


def test_drift_and_changes_that_arrived_already(spark):
    table = [(1, "drifted", 1), *[row for row in NEW if row[0] == 2], *OLD[2:7], (9, "stray", 0)]
    found = {row.k: (row.change, row.written) for row in row_changes(frame(spark, NEW), frame(spark, table), ["k"], frame(spark, OLD)).collect()}
    assert found[1] == ("DRIFTED", True) and found[2] == ("UPDATED", False) and found[8] == ("DRIFTED", True) and found[9] == ("DRIFTED", True)
    assert found[3] == ("DELETED", True) and found[4] == ("INSERTED", True) and 6 not in found


def test_merge_makes_the_table_equal_to_its_source(spark, table):
    first = table.merge(frame(spark, OLD))
    assert (first.inserted, first.updated, first.deleted) == (7, 0, 0) and listed(table.rows()) == sorted(OLD, key=str)
    second = table.merge(frame(spark, NEW))
    assert (second.inserted, second.updated, second.deleted, second.drifted) == (2, 3, 1, 0)
    assert listed(table.rows()) == sorted(NEW, key=str)
    third = table.merge(frame(spark, NEW))
    assert third.buckets == () and (third.inserted, third.updated, third.deleted, third.drifted) == (0, 0, 0, 0)


def test_untouched_buckets_keep_their_files(spark, table, tmp_path):
    rows = [(i, str(i), i) for i in range(400)]
    table.merge(frame(spark, rows))
    before = files(tmp_path / "table")
    rows[17] = (17, "changed", 17)
    result = table.merge(frame(spark, rows))
    assert len(result.buckets) == 1 and (result.updated, result.inserted, result.deleted) == (1, 0, 0)
    after = files(tmp_path / "table")
    changed = {os.path.basename(os.path.dirname(path)) for path in before.keys() ^ after.keys() | {p for p in before.keys() & after.keys() if before[p] != after[p]}}
    assert changed == {f"_bucket={result.buckets[0]}"}
    assert len({os.path.dirname(path) for path in after}) == 16


def test_a_bucket_that_loses_all_its_rows(spark, table):
    rows = [(i, str(i), i) for i in range(40)]
    table.merge(frame(spark, rows))
    own = frame(spark, rows).filter(bucket_of(["k"], 8) != 3)
    result = table.merge(own)
    assert result.buckets == (3,) and result.deleted > 0
    assert listed(table.rows()) == listed(own)
    assert table.merge(own).buckets == ()


def test_drift_is_repaired(spark, table, tmp_path):
    rows = [(i, str(i), i) for i in range(40)]
    table.merge(frame(spark, rows))
    folder = next(path for path in (tmp_path / "table" / "rows").iterdir() if path.name.startswith("_bucket="))
    for path in folder.glob("*.parquet"):
        path.unlink()
    assert table.rows().count() < 40
    result = table.merge(frame(spark, rows))
    assert result.drifted == 40 - (40 - result.drifted) > 0 and len(result.buckets) == 1 and result.updated == 0
    assert listed(table.rows()) == listed(frame(spark, rows))


def test_empty_sources_and_a_hot_key(spark, table):
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, null, id) AS k", "concat('v', id) AS v", "1 AS `a.b`")
    assert table.merge(rows).inserted == 20_001
    assert table.rows().count() == 30_000
    emptied = table.merge(frame(spark, []))
    assert emptied.deleted == 20_001 and table.rows().count() == 0
    assert table.merge(frame(spark, [])).buckets == ()


def test_a_value_that_does_not_convert_raises_and_leaves_the_table(spark, table):
    table.merge(frame(spark, OLD))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.merge(spark.createDataFrame([("x", "v", 1)], "k string, v string, `a.b` int"))
    assert listed(table.rows()) == sorted(OLD, key=str)


def test_new_rows_by_a_dotted_time(spark):
    day = datetime.datetime
    target = spark.createDataFrame([(1, day(2024, 1, 1))], "k int, `changed.at` timestamp_ntz")
    source = spark.createDataFrame([(1, day(2024, 1, 1)), (2, day(2024, 1, 2)), (3, day(2023, 1, 1)), (4, None)], "k int, `changed.at` timestamp_ntz")
    assert sorted(row.k for row in new_rows(source, target, ["k"], "changed.at").collect()) == [2, 4]


def test_only_keys_and_digests_are_shuffled(spark):
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("x" * 50).alias("v"))
    plan = row_changes(rows, rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 2 and "Window" not in plan and "Join" not in plan
