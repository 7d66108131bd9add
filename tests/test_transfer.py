"""A whole run over the sample tables, with one table whose file is missing."""

import pytest
from pyspark.sql import functions as F

from tideferry.model import (
    DEFINITION_STORE,
    RUNS,
    SOURCE_INVENTORY,
    TRANSLATION_LOG,
    TRANSLATION_RULES,
    VALIDATION_CONFIG,
)
from tideferry.plans import reports
from tideferry.plans.seed import seed_configuration
from tideferry.plans.transfer import Transfer
from tideferry.plans.views import create_views, drop_views
from tideferry.sources.control import ControlStore
from tideferry.sources.sample_tables import sample_datasets

FILES = {
    "category_pipe.txt": "1|Sports|MLB|Major League\n2|Sports|NHL|NULL\nbad line\n",
    "venue_pipe.txt": "1|Hall|Town|CA|0\n2|Arena|City|NY|\n",
    "sales_tab.txt": "1\t1\t36861\t21191\t7872\t1875\t4\t728\t109.2\t2/18/2008 02:36:48\n",
}
TABLES = {"category": 2, "venue": 5, "sales": 1, "date": 365, "Elsewhere": 1}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("transfer")
    for name, text in FILES.items():
        (root / name).write_text(text)
    store = ControlStore(spark, str(root / "control")).create()
    store.create()
    store.append_values(
        SOURCE_INVENTORY,
        [{"source_schema": "Shop", "source_table": t, "row_count_est": n} for t, n in TABLES.items() if t != "Elsewhere"]
        + [{"source_schema": "other", "source_table": "Elsewhere", "row_count_est": 1}],
    )
    store.append_values(
        DEFINITION_STORE,
        [{"source_schema": "shop", "source_table": t, "original_ddl": f"CREATE TABLE shop.{t} (x BOOL ENCODE raw)"}
         for t in TABLES],
    )
    store.append_values(
        VALIDATION_CONFIG,
        [{"config_id": "0", "check_name": "Nulls", "check_type": "NULL_RATE", "fail_threshold": 0.2}],
    )
    seed_configuration(store)
    seed_configuration(store)
    other = Transfer.open(spark, store, "earlier", sample_datasets(str(root)), str(root / "other"))
    other.assess("shop")
    run = Transfer.open(spark, store, "first", sample_datasets(str(root)), str(root / "target"), "tests")
    return run


def states(run):
    return {r.source_table: r.status for r in run.registry().collect()}


def test_whole_run(spark, run):
    assert run.assess("SHOP") == 4
    assert run.assess("shop") == 0
    assert set(states(run).values()) == {"PENDING"}

    assert run.translate("shop") == 4
    assert states(run) == dict.fromkeys(["category", "venue", "sales", "date"], "TRANSLATED")
    texts = {r.source_table: r.translated_ddl for r in run.store.read(TRANSLATION_LOG, run.run_id).collect()}
    assert texts["venue"] == "CREATE OR REPLACE TABLE venue (x BOOLEAN )"

    queries = spark.createDataFrame([("VACUUM a",), ("select 1",)], "query_text string")
    assert run.classify(queries) == 2

    batch = run.load_batch()
    assert sorted((r.table, r.rows, r.rejected) for r in batch.loaded) == [
        ("category", 2, 1), ("sales", 1, 0), ("venue", 2, 0),
    ]
    assert list(batch.failures) == ["date"] and "date2008_pipe.txt" in batch.failures["date"]
    assert batch.summary().startswith("3 of 4 tables arrived\ndate did not: ")
    assert states(run)["date"] == "TRANSLATED" and states(run)["venue"] == "LOADED"
    assert run.target("category").filter("catdesc IS NULL").count() == 1

    with pytest.raises(LookupError, match="users has not been translated"):
        run.load_table("users")

    assert run.validate_row_counts() == 3
    assert states(run) == {"category": "VALIDATED", "sales": "VALIDATED", "venue": "VALIDATED", "date": "TRANSLATED"}
    source = run.target("venue").withColumn("venueseats", F.coalesce("venueseats", F.lit(1)))
    assert run.validate_null_rates("venue", source) == 5
    results = run.results()
    counted = {r.table_name: (r.source_value, r.target_value, r.status) for r in results.filter("check_type = 'ROW_COUNT'").collect()}
    assert counted == {"CATEGORY": (2.0, 2.0, "PASS"), "SALES": (1.0, 1.0, "PASS"), "VENUE": (5.0, 2.0, "FAIL")}
    failed = [r.check_name for r in results.filter("status = 'FAIL' AND check_type = 'NULL_RATE'").collect()]
    assert failed == ["NULL_RATE:VENUE.venueseats"]

    changed = run.target("venue").withColumn("venuename", F.lit("Other"))
    assert run.validate_checksum("venue", changed, ["venueid"]).filter("status != 'CHANGED'").count() == 0

    joined = reports.validation_view(run.results(), run.registry())
    assert joined.filter("source_table IS NULL").count() == 0 and joined.count() == 9

    run.close()
    closed = run.store.current(RUNS, run.run_id).first()
    assert (closed.status, closed.triggered_by) == ("COMPLETED", "tests") and closed.completed_at
    assert run.store.current(RUNS).count() == 2
    kpis = reports.run_kpis(run.registry()).first()
    assert kpis[1:] == (4, 3, 3)


def test_audit_trail(run):
    steps = [(r.step_name, r.status) for r in reports.audit_trail(run.log()).collect()]
    assert steps[:4] == [("ASSESS_SCHEMA", "STARTED"), ("ASSESS_SCHEMA", "SUCCESS")] * 2
    assert steps[4:8] == [
        ("TRANSLATE_DEFINITIONS", "STARTED"), ("TRANSLATE_DEFINITIONS", "SUCCESS"),
        ("CLASSIFY_QUERIES", "STARTED"), ("CLASSIFY_QUERIES", "SUCCESS"),
    ]
    assert steps[8] == ("LOAD_BATCH", "STARTED")
    loads = [status for name, status in steps if name == "LOAD_TABLE"]
    assert loads.count("STARTED") == 5 and loads.count("SUCCESS") == 3 and loads.count("FAILED") == 2
    last = reports.recent_activity(run.log(), 3).collect()[-1]
    assert (last.step_name, last.status, last.rows_processed) == ("VALIDATE_NULL_RATES", "SUCCESS", 5)
    messages = {r.error_message for r in reports.failed_steps(run.log()).collect()}
    assert any("has not been translated" in m for m in messages)
    batch = run.log().filter("step_name = 'LOAD_BATCH' AND status = 'SUCCESS'").first()
    assert (batch.tables_processed, batch.tables_failed, batch.rows_processed) == (3, 1, None)


def test_a_run_can_be_continued(spark, run):
    again = Transfer(spark, run.store, run.run_id, run.datasets, run.target_root)
    assert again.validate_row_counts() == 0
    log = reports.audit_trail(again.log()).collect()
    assert [r.seq for r in log] == list(range(1, len(log) + 1))


def test_run_ids_are_folder_names(run):
    with pytest.raises(ValueError, match="unfit"):
        run.store.read(RUNS, "../x")


def test_seeding_twice_adds_nothing(run):
    assert run.store.read(TRANSLATION_RULES).count() == 14
    assert run.store.read(VALIDATION_CONFIG).count() == 3


def test_views(spark, run):
    names = create_views(run.store, run.run_id)
    shown = spark.sql("SELECT table_status, count(*) n FROM v_migration_status GROUP BY 1 ORDER BY 1").collect()
    assert [tuple(row) for row in shown] == [("TRANSLATED", 1), ("VALIDATED", 3)]
    assert spark.sql("SELECT * FROM v_recent_activity").count() == run.log().count()
    assert spark.sql("SELECT sum(table_count) s FROM v_migration_summary").first().s == 4
    drop_views(run.store, names)
    assert not spark.catalog.tableExists("v_migration_status")
