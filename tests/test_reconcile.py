import pytest
from pyspark.sql import functions as F

from tideferry.model import VALIDATION_CONFIG, with_defaults
from tideferry.operators import checksum, reconcile
from tideferry.operators.profile import column_inventory


def counts(spark, **tables):
    return spark.createDataFrame(list(tables.items()), "table_name string, n bigint")


def checks(spark, source, target, **options):
    found = reconcile.reconcile_row_counts(counts(spark, **source), counts(spark, **target), **options)
    return {row.table_name: row for row in found.collect()}


def test_row_count_edges(spark):
    found = checks(
        spark,
        {"same": 100, "below": 10000, "above": 10000, "gone": 10, "empty": 0, "third": 3, "unused": 1},
        {"SAME": 100, "Below": 9500, "above": 9499, "gone": 0, "empty": 7, "third": 4, "unknown": 5},
    )
    told = {name: (row.variance_pct, row.status, row.note) for name, row in found.items()}
    assert told == {
        "SAME": (0.0, "PASS", None),
        "BELOW": (5.0, "PASS", None),
        "ABOVE": (5.01, "FAIL", None),
        "GONE": (100.0, "FAIL", None),
        "EMPTY": (0.0, "PASS", "NO_SOURCE"),
        "THIRD": (33.3333, "FAIL", None),
        "UNKNOWN": (0.0, "PASS", "NO_SOURCE"),
        "UNUSED": (100.0, "FAIL", "NO_TARGET"),
    }
    assert found["THIRD"].check_name == "ROW_COUNT:THIRD"


def test_verdict_uses_the_unrounded_variance(spark):
    found = checks(spark, {"t": 10**9}, {"t": 10**9 - 1}, threshold=0.0)["T"]
    assert (found.variance_pct, found.status) == (0.0, "FAIL")


def test_two_source_rows_for_one_name(spark):
    twice = counts(spark, t=5).unionByName(counts(spark, T=7))
    found = reconcile.reconcile_row_counts(twice, counts(spark, t=5)).collect()
    assert [(row.source_value, row.target_value) for row in found] == [(5.0, 5.0)]


def test_null_rates(spark):
    source = spark.range(1000).selectExpr("id", "if(id < 20, null, id) AS A", "id AS b", "cast(null as int) AS c")
    target = spark.range(1000).selectExpr("if(id < 30, null, id) AS a", "if(id < 11, null, id) AS B", "cast(null as int) AS c")
    found = {r.column_name: r for r in reconcile.reconcile_null_rates("t", source, target).collect()}
    told = {n: (r.source_value, r.target_value, r.variance_pct, r.status) for n, r in found.items()}
    assert told == {
        "a": (2.0, 3.0, 1.0, "PASS"),
        "B": (0.0, 1.1, 1.1, "FAIL"),
        "c": (100.0, 100.0, 0.0, "PASS"),
    }
    assert found["B"].check_name == "NULL_RATE:T.B"


def test_table_against_itself_and_empty_tables(spark):
    rows = spark.range(10).selectExpr("id", "if(id < 3, null, id) AS x")
    same = reconcile.reconcile_null_rates("t", rows, rows).collect()
    assert {(r.variance_pct, r.status) for r in same} == {(0.0, "PASS")}
    empty = reconcile.reconcile_null_rates("t", rows.limit(0), rows.limit(0)).collect()
    assert {(r.source_value, r.status) for r in empty} == {(0.0, "PASS")}


def test_wide_tables_are_read_in_chunks(spark, monkeypatch):
    rows = spark.range(8).select(*[F.when(F.col("id") >= i, F.col("id")).alias(f"c{i}") for i in range(7)])
    whole = sorted(reconcile.null_rates(rows).collect())
    monkeypatch.setattr(reconcile, "COLUMNS_PER_SCAN", 3)
    assert sorted(reconcile.null_rates(rows).collect()) == whole
    assert whole[4] == ("c4", 50.0)


def test_awkward_column_names(spark):
    rows = spark.range(4).selectExpr("id AS `a.b`", "if(id = 0, null, 1) AS `x``y z`")
    assert sorted(reconcile.null_rates(rows).collect()) == [("a.b", 0.0), ("x`y z", 25.0)]
    found = column_inventory({"t": rows}, estimate_distinct=True).collect()
    assert sorted((r.column_name, r.null_count, r.distinct_estimate) for r in found) == [("a.b", 0, 4), ("x`y z", 1, 1)]
    matched = checksum.compare_sample(rows, rows, ["a.b"], 1.0).filter("status = 'MATCH'")
    assert matched.count() == 4


def test_missing_source_column(spark):
    found = reconcile.reconcile_null_rates("t", spark.range(1), spark.range(1).selectExpr("id", "id AS extra")).collect()
    assert {(row.column_name, row.status, row.note) for row in found} == {("id", "PASS", None), ("extra", "FAIL", "NO_SOURCE_COLUMN")}


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("2", True, 0.5), ("1", True, 0.01)], 1.0),
        ([("1", False, 0.01), ("2", True, 0.0)], 0.0),
        ([("1", False, 0.01)], 7.0),
        ([], 7.0),
    ],
)
def test_configured_threshold(spark, rows, expected):
    config = spark.createDataFrame(
        [(key, "NULL_RATE", active, share) for key, active, share in rows],
        "config_id string, check_type string, is_active boolean, fail_threshold double",
    )
    shaped = with_defaults(config, VALIDATION_CONFIG)
    threshold = reconcile.configured_threshold(shaped, "NULL_RATE", 7.0)
    assert spark.range(1).select(threshold.alias("t")).first().t == expected


def test_ranking_puts_failures_first(spark):
    rows = spark.createDataFrame(
        [("PASS", "a"), ("FAIL", "z"), ("WARNING", "b"), ("FAIL", "c")], "status string, check_name string"
    )
    assert [r.check_name for r in reconcile.ranked(rows).collect()] == ["c", "z", "b", "a"]


def compared(spark, source, target, **options):
    columns = "k bigint, v string, w string"
    left, right = spark.createDataFrame(source, columns), spark.createDataFrame(target, columns)
    return {r.k: r.status for r in checksum.compare_sample(left, right, ["k"], 1.0, **options).collect()}


def test_checksum_statuses(spark):
    found = compared(
        spark,
        [(1, "a", None), (2, "a", "b"), (3, "x", "y"), (4, "d", "d"), (4, "e", "e"), (5, "a", "b")],
        [(1, "a", None), (2, "a", None), (9, "x", "y"), (4, "e", "e"), (4, "d", "d"), (5, "b", "a")],
    )
    assert found == {
        1: "MATCH", 2: "CHANGED", 3: "MISSING_IN_TARGET", 9: "EXTRA_IN_TARGET", 4: "MATCH", 5: "CHANGED",
    }


def test_checksum_counts_copies(spark):
    row, other = (1, "a", "a"), (1, "b", "b")
    assert compared(spark, [row, row], [other, other]) == {1: "CHANGED"}
    assert compared(spark, [row, row], [row]) == {1: "CHANGED"}
    assert compared(spark, [row, other, other], [row, row, other]) == {1: "CHANGED"}


def test_checksum_across_types(spark):
    source = spark.sql("SELECT * FROM VALUES (1, '5', 1.0D), (2, 'x', 2.5D), (3, '7', 1e300D) AS t(k, v, w)")
    target = spark.sql(
        "SELECT * FROM VALUES (1L, 5, 1.00BD), (2L, null, 2.50BD), (3L, 7, null) AS t(k, v, w)"
    )
    found = {r.k: r.status for r in checksum.compare_sample(source, target, ["k"], 1.0).collect()}
    assert found == {1: "MATCH", 2: "CHANGED", 3: "CHANGED"}


def test_checksum_of_nested_values(spark):
    rows = spark.sql("SELECT 1 AS k, map('a', 1) AS m, array(1, null) AS a, struct(1 AS x, null AS y) AS s")
    other = spark.sql("SELECT 1 AS k, map('a', 1) AS m, array(null, 1) AS a, struct(1 AS x, null AS y) AS s")
    assert checksum.compare_sample(rows, rows, ["k"], 1.0).first().status == "MATCH"
    assert checksum.compare_sample(rows, other, ["k"], 1.0).first().status == "CHANGED"
    found = checksum.compare_sample(rows, other, ["k"], 1.0, columns=["m", "s"]).first()
    assert found.status == "MATCH"


def test_sample_is_the_same_on_both_sides(spark):
    keys = spark.range(20000).selectExpr("id AS k")
    chosen = keys.filter(checksum.in_sample(["k"], 0.1))
    assert 1700 < chosen.count() < 2300
    result = checksum.sample_checksum("t", checksum.compare_sample(keys, keys, ["k"])).first()
    assert (result.status, result.variance_pct, result.source_value) == ("PASS", 0.0, chosen.count())


def test_checksum_of_empty_tables(spark):
    empty = spark.range(0).selectExpr("id AS k")
    result = checksum.sample_checksum("t", checksum.compare_sample(empty, empty, ["k"])).first()
    assert (result.status, result.variance_pct) == ("NO_SAMPLE", 0.0)


def test_checksum_samples_tiny_fractions(spark):
    rows = spark.range(200_000).selectExpr("id AS k", "id AS v")
    sampled = checksum.compare_sample(rows, rows, ["k"], fraction=0.0002).count()
    assert 10 < sampled < 90


def test_checksum_of_unlike_key_types_and_letter_case(spark):
    source = spark.range(2000).selectExpr("id AS Key", "cast(id as string) AS v")
    for kind in ("double", "decimal(12,2)", "string"):
        target = source.selectExpr(f"cast(key as {kind}) AS KEY", "v AS V")
        found = {row.status for row in checksum.compare_sample(source, target, ["key"], 0.5).collect()}
        assert found == {"MATCH"}, kind


def test_dotted_column_names_stay_whole(spark):
    rows = spark.range(2).selectExpr("id AS `a.b`")
    found = reconcile.null_rate_columns(reconcile.reconcile_null_rates("t", rows, rows)).collect()
    assert [(row.table_name, row.column_name) for row in found] == [("T", "a.b")]
