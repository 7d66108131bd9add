import datetime

import pytest
from pyspark.sql import functions as F

from tideferry.functions.times import elapsed_millis, elapsed_seconds
from tideferry.operators.history import clear_history, keep_history
from tideferry.operators.incremental import new_rows
from tideferry.operators.registry import latest_definition, pending_work, register_new
from tideferry.operators.state import advance, latest_rows, latest_value, matching
from tideferry.sources.shared import scratch_path


def test_newest_row_with_equal_times(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, "old"), ("a", 2, 1, "tie"), ("a", 2, 2, None), ("b", 1, 1, "only")],
        "k string, at int, seq int, status string",
    )
    found = {r.k: r.status for r in latest_rows(rows, ["k"], ["at", "seq"]).collect()}
    assert found == {"a": None, "b": "only"}
    counted = {r.k: r.changes for r in latest_value(rows, ["k"], "status", ["at", "seq"]).collect()}
    assert counted == {"a": 3, "b": 1}


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    rows = spark.range(10000, numPartitions=4).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS at")
    plan = latest_rows(rows, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_hot_keys_on_both_sides_of_a_join(spark, small_partitions):
    left = spark.range(200_000).selectExpr("if(id % 3 = 0, -7, id) AS k", "uuid() AS v")
    right = spark.range(90_000, numPartitions=3).selectExpr("if(id % 3 = 0, 0, id) AS k")
    joined = new_rows(left, right, ["k"])
    found = joined.agg(F.count(F.lit(1)), F.count_if(F.col("k") == -7), F.max("v"))
    hot = len(range(0, 200_000, 3))
    assert tuple(found.collect()[0])[:2] == (hot + len([k for k in range(200_000) if k % 3 and k >= 90_000]), hot)
    final = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in final
    # One exchange per side: the key side is not grouped first.
    assert "HashAggregate(keys=[k" not in final


INVENTORY = "source_schema string, source_table string, row_count_est bigint, size_bytes_est bigint"


def test_registering_twice_adds_nothing(spark):
    inventory = spark.createDataFrame(
        [("s", "Users", 1, 1), ("S", "USERS", 2, 2), ("s", "dates", 3, 3), ("t", "users", 4, 4)], INVENTORY
    )
    none = spark.createDataFrame([], "source_schema string, source_table string")
    first = register_new(inventory, none)
    assert sorted((r.source_schema.upper(), r.target_table) for r in first.collect()) == [
        ("S", "DATES"), ("S", "USERS"), ("T", "USERS"),
    ]
    assert register_new(inventory, first).count() == 0
    assert {(r.status, r.target_schema) for r in first.collect()} == {("PENDING", "TARGET")}


def test_matching_ignores_case_and_copies(spark):
    current = spark.createDataFrame([("s", "a", 0), ("s", "b", 0)], "source_schema string, source_table string, change_no bigint")
    matched = spark.createDataFrame([("S", "A")] * 3 + [("x", "b")], "source_schema string, source_table string")
    rows = matching(current, matched, ["source_schema", "source_table"])
    changed = advance(rows, status="LOADED", doubled=F.col("change_no") * 2).collect()
    assert [(r.source_table, r.status, r.change_no) for r in changed] == [("a", "LOADED", 1)]


def test_pending_work_in_order(spark):
    rows = spark.createDataFrame(
        [("b", 100, "TRANSLATED"), ("a", 100, "TRANSLATED"), ("c", 1, "TRANSLATED"), ("d", 0, "LOADED"), ("e", None, "TRANSLATED")],
        "source_table string, priority bigint, status string",
    )
    assert [r.source_table for r in pending_work(rows).collect()] == ["c", "a", "b", "e"]


def test_latest_definition(spark):
    rows = spark.createDataFrame(
        [("T", 1, "a", "old"), ("t", 2, "b", "new"), ("T", 2, "c", "newest")],
        "source_table string, translated_at int, translation_id string, translated_ddl string",
    )
    assert [r.translated_ddl for r in latest_definition(rows).collect()] == ["newest"]


def test_history(spark):
    path = scratch_path(spark, "history-test")
    spark.range(10).write.parquet(f"{path}/old")
    kept = keep_history(spark, f"{path}/old", F.col("id") > 6, f"{path}/new")
    assert kept.count() == 3
    cleared = clear_history(spark, f"{path}/new", f"{path}/empty")
    assert (cleared.count(), cleared.schema) == (0, kept.schema)
    with pytest.raises(Exception):
        keep_history(spark, f"{path}/old", F.lit(True), f"{path}/new")


def moments(spark, rows):
    days = [(key, datetime.datetime(2024, 1, day)) for key, day in rows]
    return spark.createDataFrame(days, "k int, at timestamp_ntz")


def test_incremental(spark):
    source = moments(spark, [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)])
    target = moments(spark, [(1, 1), (4, 4)])

    def keys(*more):
        return sorted(r.k for r in new_rows(source, target, ["k"], *more).collect())

    assert keys() == [2, 3, 5]
    assert keys("at") == [5]
    assert keys("at", datetime.timedelta(days=1)) == [3, 5]
    assert sorted(r.k for r in new_rows(source, target.limit(0), ["k"], "at").collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize(
    "ended, millis, seconds",
    [("2024-01-01 00:00:01.4999", 1499, 1), ("2024-01-01 00:00:01.5", 1500, 2), ("2024-01-03 01:02:03", 176523000, 176523),
     ("2024-01-01 00:00:00", 0, 0)],
)
def test_elapsed(spark, ended, millis, seconds):
    row = spark.sql(f"SELECT timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'{ended}' b").select(
        elapsed_millis(F.col("a"), F.col("b")).alias("m"), elapsed_seconds(F.col("a"), F.col("b")).alias("s")
    ).first()
    assert (row.m, row.s) == (millis, seconds)


def test_new_rows_keep_null_keys_and_times(spark):
    source = spark.createDataFrame([(1, 5), (2, None), (None, 6), (3, 1)], "k int, at int")
    target = spark.createDataFrame([(1, 5), (None, 2)], "k int, at int")
    assert sorted(str(r.k) for r in new_rows(source, target, ["k"]).collect()) == ["2", "3"]
    source = source.selectExpr("k", "timestamp_seconds(at) AS at")
    target = target.selectExpr("k", "timestamp_seconds(at) AS at")
    assert sorted(str(r.k) for r in new_rows(source, target, ["k"], "at").collect()) == ["2", "None"]
