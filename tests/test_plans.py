"""What the plans must look like, whatever the size of the data."""

import re

import pytest

from tideferry.queries import QUERIES, runs
from tideferry.queries.stand_ins import ALL
from tideferry.sources.tables import read_table

FOLDER = "/root/testdata/sf0.001"

# These write their input first, so their result is a plain scan.
WRITTEN = {name for name in QUERIES if name.startswith("delimited_")} | set(runs.QUERIES)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def plan(spark, name: str) -> str:
    return plan_of(QUERIES[name](spark, FOLDER))


# Their windows see one part of a sorted table, or one row per part.
BY_PART = {"step_pairs", "open_steps"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITTEN - BY_PART))
def test_no_python_workers_cross_joins_or_windows(spark, name):
    text = plan(spark, name)
    for unwanted in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Coalesce ("):
        assert unwanted not in text, unwanted


@pytest.mark.parametrize("name", sorted(BY_PART))
def test_windows_see_parts_and_not_runs(spark, name):
    text = plan(spark, name)
    windows = re.findall(r"windowspecdefinition\((\w+)#", text)
    assert windows and set(windows) <= {"_part"}


def test_row_counts_read_only_filter_columns(spark):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", plan(spark, "row_count_reconcile"))
    assert len(schemas) == 18
    read = sorted(schema.split(":")[0] for schema in schemas if schema)
    assert read == ["event_type", "l_quantity", "o_totalprice"]


def test_null_rates_scan_each_side_once(spark):
    text = plan(spark, "null_rate_reconcile")
    assert len(re.findall(r"\n\(\d+\) Scan parquet", text)) == 6


def test_column_inventory_scans_each_table_once(spark):
    assert len(re.findall(r"\n\(\d+\) Scan parquet", plan(spark, "column_inventory"))) == len(ALL)


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("workload_q6", "EqualTo(c_mktsegment,MACHINERY)"),
        ("workload_q7", "EqualTo(user_id,7)"),
        ("workload_q10", "GreaterThan(l_extendedprice,50000.0)"),
        ("incremental_load", "GreaterThanOrEqual(o_orderdate,"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


@pytest.mark.parametrize("name", ["recent_activity", "latest_run", "workload_q6", "workload_q10"])
def test_top_rows_are_taken_without_a_full_sort(spark, name):
    text = plan(spark, name)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize(
    "name", ["latest_state", "latest_definition", "rule_dedupe", "registry_register_new", "batch_load_summary"]
)
def test_groups_are_combined_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert re.search(r"Functions \[\d+\]: \[partial_(max|min|count)", text)


@pytest.mark.parametrize("name", ["log_kpis", "run_kpis", "sample_checksum", "workload_q1", "workload_q3", "status_summary"])
def test_totals_hash_without_sorting(spark, name):
    assert "SortAggregate" not in plan(spark, name)


def test_previews_are_cut_before_they_are_sorted(spark):
    text = plan(spark, "definition_preview")
    shuffled = text.index("Exchange")
    assert text.index("Sort") < shuffled < text.index("Project", shuffled) < text.index("Scan")
    assert "text#" not in text.split("rangepartitioning")[1].split("\n")[0]
