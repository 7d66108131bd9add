"""Snapshots of a run's control tables, and what is appended after them."""

import pytest
from pyspark.sql import functions as F

from tideferry.model import REGISTRY, RUNS, STEP_LOG, TRANSLATION_RULES
from tideferry.sources.control import ControlStore


@pytest.fixture
def store(spark, tmp_path):
    store = ControlStore(spark, str(tmp_path / "control")).create()
    for run in ("a", "b"):
        store.append_values(RUNS, [{"run_name": run, "status": "IN_PROGRESS"}], run)
        for i in range(4):
            store.append_values(REGISTRY, [{"registry_id": f"{run}{i}", "source_table": f"t{i}", "status": "PENDING"}], run)
            store.append_values(STEP_LOG, [{"log_id": f"{run}{i}", "phase": "LOAD", "status": "STARTED", "seq": i}], run)
        store.change(REGISTRY, store.current(REGISTRY, run).filter("source_table < 't2'"), run, status="LOADED")
    return store


def states(store, run):
    return {row.source_table: (row.status, row.run_id) for row in store.current(REGISTRY, run).collect()}


def files(frame):
    return [name for name in frame.inputFiles() if name.endswith(".parquet")]


def test_a_compacted_run_reads_one_file_per_table(store):
    before = states(store, "a"), sorted(store.read(STEP_LOG, "a").collect()), store.current(RUNS, "a").collect()
    assert len(files(store.current(REGISTRY, "a"))) > 4
    assert store.compact("a") == ["runs", "registry", "step_log"]
    assert (states(store, "a"), sorted(store.read(STEP_LOG, "a").collect()), store.current(RUNS, "a").collect()) == before
    for frame in (store.current(REGISTRY, "a"), store.read(STEP_LOG, "a"), store.current(RUNS, "a")):
        assert len(files(frame)) == 1
    assert len(files(store.current(REGISTRY, "b"))) > 4 and states(store, "b")["t0"] == ("LOADED", "b")


def test_rows_after_a_snapshot(store):
    store.compact("a")
    store.change(REGISTRY, store.current(REGISTRY, "a").filter("source_table = 't3'"), "a", status="FAILED")
    store.append_values(STEP_LOG, [{"log_id": "late", "phase": "LOAD", "status": "SUCCESS", "seq": 9}], "a")
    assert states(store, "a") == {"t0": ("LOADED", "a"), "t1": ("LOADED", "a"), "t2": ("PENDING", "a"), "t3": ("FAILED", "a")}
    assert store.read(STEP_LOG, "a").count() == 5 and len(files(store.read(STEP_LOG, "a"))) == 2
    again = ControlStore(store.spark, store.root)
    assert states(again, "a")["t3"] == ("FAILED", "a")
    again.compact("a")
    assert len(files(store.read(STEP_LOG, "a"))) == 1 and states(store, "a")["t3"] == ("FAILED", "a")
    # All runs together are read as they were written, with every version.
    assert store.read(REGISTRY).filter("run_id = 'a'").count() == 7 and store.current(REGISTRY).count() == 8


def test_a_snapshot_that_is_not_whole_is_passed_over(store, tmp_path):
    store.compact("a")
    before = states(store, "a")
    folder = tmp_path / "control" / "_snapshots" / "registry" / "run_id=a" / "2" / "rows"
    store.current(REGISTRY, "a").limit(1).drop("run_id").write.parquet(str(folder))
    assert states(store, "a") == before
    store.compact("a")
    assert states(store, "a") == before


def test_runs_without_rows_and_configuration_stay(store):
    assert store.compact("nobody") == []
    assert store.read(TRANSLATION_RULES).count() == 0 and store.current(REGISTRY, "nobody").count() == 0
    store.append(REGISTRY, store.current(REGISTRY, "a").withColumn("registry_id", F.concat(F.lit("c"), "registry_id")), "c")
    assert store.compact("c") == ["registry"] and set(states(store, "c").values()) == {("LOADED", "c"), ("PENDING", "c")}
