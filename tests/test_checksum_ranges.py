"""Keys that do not convert, and the search for differing rows by ranges of keys."""

import random

import pytest
from pyspark.sql import functions as F

from tideferry.operators import checksum
from tideferry.operators.checksum import KeyRanges, compare_sample, differences, differing_ranges, locate, sample_checksum


def test_keys_without_a_value_in_the_target_are_not_lost(spark):
    source = spark.range(2000).select(F.when(F.col("id") < 500, F.concat(F.lit("k"), "id")).otherwise(F.col("id").cast("string")).alias("k"), F.lit(1).alias("v"))
    target = spark.range(500, 2000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    compared = compare_sample(source, target, ["k"])
    result = sample_checksum("t", compared).first()
    assert result.status == "FAIL" and 150 < result.source_value < 250
    whole = compare_sample(source, target, ["k"], 1.0)
    assert whole.groupBy("status").count().collect().__len__() == 2
    lost = whole.filter("unconverted IS NOT NULL").collect()
    assert len(lost) == 500 and {row.status for row in lost} == {"MISSING_IN_TARGET"} and {row.k for row in lost} == {None}
    assert '{"k":"k17"}' in {row.unconverted for row in lost}


def test_lost_rows_of_composite_keys_are_told_apart(spark):
    source = spark.range(4000).selectExpr("if(id % 4 = 0, concat('x', id), cast(id AS string)) AS a", "id % 7 AS b")
    target = spark.range(4000).filter("id % 4 <> 0").selectExpr("id AS a", "id % 7 AS b")
    whole = compare_sample(source, target, ["a", "b"], 1.0)
    assert {row.status: row["count"] for row in whole.groupBy("status").count().collect()} == {"MATCH": 3000, "MISSING_IN_TARGET": 1000}


def test_a_null_key_is_not_a_key_that_does_not_convert(spark):
    source = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    target = spark.createDataFrame([(None, 1)], "k bigint, v int")
    found = {(row.unconverted, row.status) for row in compare_sample(source, target, ["k"], 1.0).collect()}
    assert found == {(None, "MATCH"), ('{"k":"x"}', "MISSING_IN_TARGET")}


KEYS = {
    "bigint": "CAST(id * 7 - 5000 AS bigint)",
    "string": "concat('key ', lpad(id, 5, '0'), 'é')",
    "date": "date_add(date'2000-01-01', CAST(id AS int))",
    "timestamp_ntz": "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS int))",
    "decimal(12,3)": "CAST(id / 8 AS decimal(12,3))",
    "double": "CAST(id AS double) / 3",
    "binary": "CAST(lpad(id, 5, '0') AS binary)",
    "boolean": "id % 2 = 0",
}


@pytest.mark.parametrize("kind", sorted(KEYS))
def test_locate_lists_what_a_full_comparison_lists(spark, kind):
    rows = spark.range(3000).selectExpr(f"{KEYS[kind]} AS k", "id AS v", "id")
    chance = random.Random(kind)
    ids = {name: sorted(chance.sample(range(3000), 5)) for name in ("lost", "changed", "copied")}
    target = rows.filter(~F.col("id").isin(ids["lost"])).withColumn("v", F.when(F.col("id").isin(ids["changed"]), -1).otherwise(F.col("v")))
    target = target.unionByName(rows.filter(F.col("id").isin(ids["copied"])))
    source, target = rows.drop("id"), target.drop("id")
    expected = {tuple(row) for row in differences(compare_sample(source, target, ["k"], 1.0)).collect()}
    assert expected and {tuple(row) for row in locate(source, target, ["k"], ranges=8, few=10).collect()} == expected


def test_locate_with_nulls_texts_and_rows_beyond_the_sample(spark):
    source = spark.createDataFrame([(None, 1), ("a", 1), ("5", 1), ("7", 1), ("900", 1)], "k string, v int")
    target = spark.createDataFrame([(None, 2), (5, 1), (-4, 1), (9000, 1)], "k int, v int")
    found = {(row.k, row.unconverted, row.status) for row in locate(source, target, ["k"], ranges=4, few=1).collect()}
    assert found == {
        (None, None, "CHANGED"),
        (None, '{"k":"a"}', "MISSING_IN_TARGET"),
        (7, None, "MISSING_IN_TARGET"),
        (900, None, "MISSING_IN_TARGET"),
        (-4, None, "EXTRA_IN_TARGET"),
        (9000, None, "EXTRA_IN_TARGET"),
    }


def test_equal_and_empty_tables_have_no_ranges(spark):
    rows = spark.range(1000).selectExpr("id AS k", "id AS v")
    assert differing_ranges(rows, rows, ["k"]) == KeyRanges((), False)
    assert locate(rows, rows, ["k"]).collect() == []
    empty = rows.limit(0)
    assert locate(empty, empty, ["k"]).collect() == []
    assert locate(rows, empty, ["k"]).count() == 1000


def _scanned_rows(frame):
    """Rows that came out of the frame's only scan."""
    plan = frame._jdf.queryExecution()
    assert plan.toRdd().count() >= 0
    leaves = plan.executedPlan().collectLeaves()
    return leaves.head().metrics().get("numOutputRows").get().value()


def test_equal_ranges_are_not_read_again(spark, tmp_path):
    rows = spark.range(200_000).selectExpr("id AS k", "id % 13 AS v")
    for side, changed in (("source", -1), ("target", 123_456)):
        other = rows.withColumn("v", F.when(F.col("k") == changed, 99).otherwise(F.col("v")))
        other.repartitionByRange(20, "k").sortWithinPartitions("k").write.parquet(str(tmp_path / side))
    source, target = (spark.read.parquet(str(tmp_path / side)) for side in ("source", "target"))
    ranges = differing_ranges(source, target, ["k"], ranges=16, few=1000)
    assert len(ranges.spans) == 1 and not ranges.nulls
    low, high = ranges.spans[0]
    assert low <= 123_456 < high and high - low < 20_000
    sides = checksum._Sides(source, target, ["k"], None)
    again = checksum._within(sides, ranges).frames[0]
    assert "PushedFilters: [" in again._jdf.queryExecution().toString()
    assert _scanned_rows(source) == 200_000
    # One of twenty files holds the range, or two.
    assert _scanned_rows(again) <= 20_000 * 1.2
    assert [row.k for row in locate(source, target, ["k"], ranges=16, few=1000).collect()] == [123_456]
