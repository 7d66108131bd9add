"""Work on texts is dealt to all cores, however few row groups its table has."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideferry.operators.rewrite import FUNCTION_MAP, TYPE_MAP, Rule, apply_rules
from tideferry.queries import texts
from tideferry.queries.stand_ins import query_log


def tasks_with_rows(rows):
    return rows.select(F.spark_partition_id().alias("part")).distinct().count()


def test_definitions_of_one_row_group(spark, tmp_path):
    part = spark.range(400).selectExpr("id AS p_partkey", "'steel' AS p_name", "'SMALL' AS p_type", "7 AS p_size")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for query in (texts.rewrite_full, texts.rewrite_cleanup, texts.rewrite_qualify):
        found = query(spark, str(tmp_path))
        assert tasks_with_rows(found) >= 8
        assert found.count() == found.select("p_partkey").distinct().count() == 400


def test_query_log_of_one_row_group(spark, tmp_path):
    events = spark.range(400).selectExpr("id AS event_id", "'click' AS event_type", "id % 3 AS user_id", "1.0D AS value")
    events.unionByName(events.limit(1)).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = query_log(spark, str(tmp_path))
    assert tasks_with_rows(found) >= 8
    assert found.count() == 401


def test_a_few_rules_have_fixed_patterns(spark):
    rules = [Rule(TYPE_MAP, "a|b", "$1x"), Rule(FUNCTION_MAP, "IF(", "IFF("), Rule(FUNCTION_MAP, r"(\d)-(\d)", "$2-$1", is_regex=True)]
    rows = spark.createDataFrame([("a IF(1-2) b",), (None,)], "t string").select(apply_rules(F.col("t"), rules).alias("t"))
    assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {row.t for row in rows.collect()} == {"$1x IFF(2-1) $1x", None}
