"""Loads to new folders: failures, pointers, one pass over the text, line numbers; runs over two schemas."""

import gzip
import shutil

import pytest
from pyspark.sql import functions as F

from tideferry.model import COLUMN_SKETCHES, DEFINITION_STORE, SOURCE_INVENTORY
from tideferry.operators.load import current_load, load_dataset, load_into, open_loaded, rejected_lines, remove_old_loads
from tideferry.operators.sketches import distinct_inventory
from tideferry.plans.seed import seed_configuration
from tideferry.plans.transfer import Transfer
from tideferry.queries import runs
from tideferry.session import settings
from tideferry.sources.control import ControlStore
from tideferry.sources.delimited import Dataset, Field

FIELDS = (Field("id", "int", required=True), Field("name", "string"))


def write_half_broken(folder):
    """A good file, and one that can't be read to its end."""
    folder.mkdir()
    (folder / "a.txt").write_text("".join(f"{i}|new\n" for i in range(50_000)))
    packed = gzip.compress(b"".join(b"%d|new %d\n" % (i, i * 7919) for i in range(50_000)))
    (folder / "b.txt.gz").write_bytes(packed[: len(packed) // 2])


def test_a_load_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    (tmp_path / "old.txt").write_text("1|a\n2|b\nx|c\n")
    write_half_broken(tmp_path / "new")
    target, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    load_dataset(spark, Dataset("t", str(tmp_path / "old.txt"), FIELDS), target, rejects)
    dataset = Dataset("t", str(tmp_path / "new"), FIELDS)
    with pytest.raises(Exception):
        load_dataset(spark, dataset, target, rejects)
    assert sorted(open_loaded(spark, dataset, target).collect()) == [(1, "a"), (2, "b")]
    assert spark.read.parquet(rejects).count() == 1
    (tmp_path / "new" / "b.txt.gz").unlink()
    assert load_dataset(spark, dataset, target, rejects).rows == 50_000
    assert open_loaded(spark, dataset, target).count() == 50_000 and spark.read.parquet(rejects).count() == 0
    # Two old folders: the first load's, and what the failed one left.
    assert remove_old_loads(spark, target) == 2
    assert open_loaded(spark, dataset, target).count() == 50_000 and current_load(spark, target)


def test_rejects_are_made_without_the_text(spark, tmp_path):
    (tmp_path / "x.txt").write_text("1|a\nx|b\n\n2|c|d\n3|e")
    load_into(spark, Dataset("t", str(tmp_path / "x.txt"), FIELDS), str(tmp_path / "t"))
    (tmp_path / "x.txt").unlink()
    found = sorted((row.line_number, row.line, row.reason) for row in rejected_lines(spark, str(tmp_path / "t")).collect())
    assert found == [(2, "x|b", "TYPE:id"), (3, "", "ARITY"), (4, "2|c|d", "ARITY")]


def test_one_write_without_a_sort_or_a_second_scan(spark, tmp_path):
    (tmp_path / "x.txt").write_text("1|a\nx|b\n" * 1000)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    result = load_into(spark, Dataset("t", str(tmp_path / "x.txt"), FIELDS), str(tmp_path / "t"))
    assert (result.lines, result.rows, result.rejected) == (2000, 1000, 1000)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert sorted(path.name for path in (tmp_path / "t").iterdir() if path.is_dir()) == ["bad=false", "bad=true"]


def test_all_good_all_bad_and_no_lines(spark, tmp_path):
    for name, text, rows, bad in (("good", "1|a\n", 1, 0), ("bad", "x\ny\n", 0, 2), ("none", "", 0, 0)):
        (tmp_path / f"{name}.txt").write_text(text)
        dataset = Dataset("t", str(tmp_path / f"{name}.txt"), FIELDS)
        result = load_dataset(spark, dataset, str(tmp_path / name), str(tmp_path / f"{name}-rejects"))
        assert (result.rows, result.rejected) == (rows, bad)
        assert open_loaded(spark, dataset, str(tmp_path / name)).count() == rows
        assert open_loaded(spark, dataset, result.path).schema == dataset.schema
        assert spark.read.parquet(str(tmp_path / f"{name}-rejects")).count() == bad


def test_line_numbers_over_many_splits_and_files(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    expected = set()
    for file, lines in (("a.txt", 5000), ("b.txt", 1), ("c.txt", 777)):
        texts = []
        for number in range(1, lines + 1):
            bad = number % 97 == 0 or number in (1, lines)
            texts.append(f"{'x' if bad else number}|{'é' * (number % 50)}{file}")
            if bad:
                expected.add((file, number))
        (folder / file).write_text("\n".join(texts) + ("\n" if file != "c.txt" else ""), encoding="utf-8")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "7k", "spark.sql.files.openCostInBytes": "0"}):
        load_into(spark, Dataset("t", str(folder), FIELDS), str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert rows.select("_source_file", "_split_start").distinct().count() > 30
    found = {(row.source_file.rsplit("/", 1)[1], row.line_number) for row in rejected_lines(spark, str(tmp_path / "t")).collect()}
    assert found == expected


@pytest.fixture(scope="module")
def two(spark, tmp_path_factory):
    """One table name in two schemas: three rows in one, five in the other."""
    root = tmp_path_factory.mktemp("schemas")
    store = ControlStore(spark, str(root / "control")).create()
    seed_configuration(store)
    datasets = {}
    for schema, rows, estimate in (("s1", 3, 3), ("S2", 5, 1000)):
        (root / f"{schema}.txt").write_text("".join(f"{i}|{schema}\n" for i in range(rows)))
        datasets[f"{schema}.t".lower()] = Dataset("t", str(root / f"{schema}.txt"), FIELDS)
        store.append_values(SOURCE_INVENTORY, [{"source_schema": schema, "source_table": "t", "row_count_est": estimate}])
        store.append_values(DEFINITION_STORE, [{"source_schema": schema, "source_table": "T", "original_ddl": "CREATE TABLE t (id INT)"}])
    run = Transfer.open(spark, store, "two", datasets, str(root / "target"))
    assert run.assess("S1") == run.assess("s2") == 1
    assert run.translate() == 2
    return run


def test_tables_of_two_schemas_stay_apart(spark, two):
    with pytest.raises(LookupError, match="several schemas"):
        two.load_table("t")
    batch = two.load_batch()
    assert not batch.failures and sorted(result.rows for result in batch.loaded) == [3, 5]
    assert two.target("T", "s1").count() == 3 and two.target("t", "s2").count() == 5
    with pytest.raises(LookupError, match="several schemas"):
        two.target("t")
    assert two.validate_row_counts() == 2
    checks = {row.source_schema: (row.source_value, row.target_value, row.status) for row in two.results().collect()}
    assert checks == {"S1": (3.0, 3.0, "PASS"), "S2": (1000.0, 5.0, "FAIL")}
    assert two.results().select("registry_id").distinct().count() == 2


def test_checks_of_one_schema_know_their_table(spark, two):
    assert two.validate_null_rates("t", two.target("t", "s1"), "s1") == 2
    changed = two.target("t", "s2").withColumn("name", F.lit("other"))
    assert two.validate_checksum("t", changed, ["id"], "s2").filter("status <> 'CHANGED'").count() == 0
    owners = {(row.check_type, row.source_schema) for row in two.results().filter("registry_id IS NOT NULL").collect()}
    assert {("NULL_RATE", "S1"), ("CHECKSUM", "S2")} <= owners


def test_sources_are_given_by_name_with_schema(spark, two):
    two.load_table("t", "s1")
    two.load_table("t", "s2")
    with pytest.raises(LookupError, match="several schemas"):
        two.validate_row_counts({"t": spark.range(3)})
    assert two.validate_row_counts({"s1.t": spark.range(3), "s2.t": spark.range(5)}, threshold=0.0) == 2
    newest = two.results().orderBy(F.desc("checked_at")).limit(2).collect()
    assert {(row.source_schema, row.status) for row in newest} == {("S1", "PASS"), ("S2", "PASS")}


def test_sketches_of_a_run(spark, two):
    assert two.measure_distinct() == 2
    found = {(row.table_name, row.column_name): row.distinct_estimate for row in distinct_inventory(two.store.read(COLUMN_SKETCHES, two.run_id)).collect()}
    assert found == {("S1.T", "id"): 3, ("S1.T", "name"): 1, ("S2.T", "id"): 5, ("S2.T", "name"): 1}


def test_a_failed_reload_in_a_run(spark, two, tmp_path):
    write_half_broken(tmp_path / "new")
    before = two.target("t", "s1").count()
    broken = Transfer(spark, two.store, two.run_id, two.datasets | {"s1.t": Dataset("t", str(tmp_path / "new"), FIELDS)}, two.target_root)
    with pytest.raises(Exception):
        broken.load_table("t", "s1")
    assert two.target("t", "s1").count() == before == 3
    assert two.log().filter("step_name = 'LOAD_TABLE' AND status = 'FAILED' AND registry_id IS NOT NULL").count() == 1


def test_run_queries_follow_their_tables(spark, tmp_path):
    folder = tmp_path / "tables"
    shutil.copytree("/root/testdata/sf0.001", folder, copy_function=shutil.copyfile)
    folder.chmod(0o755)
    count = lambda: {row.source_table: row.row_count_est for row in runs.run_registry(spark, str(folder)).collect()}["nation"]
    assert count() == 25
    three = spark.read.parquet(str(folder / "nation.parquet")).limit(3).toPandas()
    (folder / "nation.parquet").chmod(0o644)
    three.to_parquet(folder / "nation.parquet")
    assert count() == 3
