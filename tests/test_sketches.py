"""Sketches of loads, merged, against exact counts."""

from pyspark.sql import functions as F

from tideferry.operators.sketches import ERROR, column_sketches, distinct_inventory, merged, replaced_loads


def estimates(sketches):
    return {row.column_name: (row.row_count, row.null_count, row.distinct_estimate) for row in distinct_inventory(sketches).collect()}


def test_two_loads_equal_one_of_both(spark):
    rows = spark.range(60_000).selectExpr("id AS k", "id % 300 AS few", "concat('v', id % 20000) AS `v.x`", "if(id % 3 = 0, NULL, id / 7) AS d")
    loads = [column_sketches({"t": rows.filter(f"k % 5 {sign} 0")}, sign) for sign in ("=", "<>")]
    apart, whole = loads[0].unionByName(loads[1]), column_sketches({"t": rows}, "all")
    assert estimates(apart) == estimates(whole)
    found = estimates(apart)
    assert found["few"][2] == 300 and found["d"][1] == 20_000
    for name, exact in (("k", 60_000), ("v.x", 20_000), ("d", 40_000)):
        assert abs(found[name][2] - exact) <= 3 * ERROR * exact, name


def test_a_load_measured_again_counts_once(spark):
    rows = spark.range(1000).selectExpr("id AS k")
    first = column_sketches({"t": rows.filter("k < 500")}, "a").withColumn("measured_at", F.lit(1))
    again = column_sketches({"t": rows.filter("k < 400")}, "a").withColumn("measured_at", F.lit(2))
    other = column_sketches({"t": rows.filter("k >= 900")}, "b").withColumn("measured_at", F.lit(1))
    newest = replaced_loads(first.unionByName(again).unionByName(other))
    assert estimates(newest) == {"k": (500, 0, 500)}


def test_all_types_nulls_and_empty_tables(spark):
    rows = spark.sql(
        "SELECT 1Y AS b, CAST(NULL AS STRING) AS n, array(1, 2) AS a, map('a', 1) AS m, struct(1 AS x) AS s, date'2024-01-01' AS d, X'00' AS bin, 1.5BD AS dec, true AS t"
    )
    found = estimates(column_sketches({"t": rows.unionByName(rows)}))
    assert found["m"][2] is None and found["n"] == (2, 2, 0)
    assert all(found[c][2] == 1 for c in ("b", "a", "s", "d", "bin", "dec", "t"))
    assert set(estimates(column_sketches({"t": rows.limit(0)})).values()) <= {(0, 0, 0), (0, 0, None)}


def test_sketches_stay_small(spark):
    sketch = merged(column_sketches({"t": spark.range(300_000).selectExpr("uuid() AS u")})).first().sketch
    assert len(sketch) < 40_000
