"""A whole run over the driver tables, as queries over what it left in its store.

Four tables are written as delimited text, loaded and checked; the text of a
fifth never arrives. One run serves all queries of a session, as long as the
files of its tables are the same and what it left is still there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideferry.functions.frames import union_all
from tideferry.model import (
    CLASSIFICATION_LOG,
    DEFINITION_STORE,
    RUNS,
    SOURCE_INVENTORY,
    TRANSLATION_LOG,
)
from tideferry.plans.seed import seed_configuration
from tideferry.plans.transfer import Transfer
from tideferry.plans.views import create_views, drop_views
from tideferry.queries.stand_ins import QUERY_LOG_SQL, query_log
from tideferry.sources.control import ControlStore
from tideferry.sources.delimited import Dataset, Field
from tideferry.sources.shared import path_exists, scratch_path
from tideferry.sources.tables import read_table, read_tables

LOADED = ("customer", "supplier", "nation", "region")
MISSING = "orders"

# A column's declaration in a source definition by its type, and what rewriting leaves of it.
_DECLARED = {
    "int": ("INTEGER ENCODE az64", "INTEGER "),
    "bigint": ("BIGINT", "BIGINT"),
    "double": ("FLOAT8 ENCODE raw", "FLOAT8 "),
    "string": ("VARCHAR(100)", "VARCHAR(100)"),
    "timestamp_ntz": ("TIMESTAMP DEFAULT GETDATE()", "TIMESTAMP_NTZ DEFAULT CURRENT_TIMESTAMP()"),
}


def _definition(name: str, rows: DataFrame) -> str:
    columns = ", ".join(f"{f.name} {_DECLARED[f.dataType.simpleString()][0]}" for f in rows.schema.fields)
    return f"CREATE TABLE store.{name} ({columns}) DISTSTYLE ALL;"


def _fields(rows: DataFrame) -> tuple[Field, ...]:
    return tuple(Field(f.name, f.dataType.simpleString()) for f in rows.schema.fields)


def _listing(spark: SparkSession, folder: str, names: Sequence[str]) -> tuple:
    """Files of some tables with their lengths and times, as Spark's file system lists them."""
    found = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            status = files.next()
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


_RUNS: dict[tuple, Transfer] = {}


def _once(make: Callable[[SparkSession, str], Transfer], spark: SparkSession, folder: str, names: Sequence[str]) -> Transfer:
    """A run over the files as they are now, made anew when they or what the run wrote have changed."""
    key = (make.__name__, spark.sparkContext.applicationId, _listing(spark, folder, names))
    run = _RUNS.get(key)
    if run is None or not path_exists(spark, run.store.root):
        run = _RUNS[key] = make(spark, folder)
    return run


def _run(spark: SparkSession, folder: str) -> Transfer:
    root = scratch_path(spark, "run")
    tables = read_tables(spark, folder, (*LOADED, MISSING))
    datasets = {name: Dataset(name, f"{root}/text/{name}", _fields(rows), "|") for name, rows in tables.items()}
    for name in LOADED:
        line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in tables[name].columns])
        tables[name].select(line.alias("value")).write.text(f"{root}/text/{name}")

    store = ControlStore(spark, f"{root}/control").create()
    seed_configuration(store)
    known = [rows.agg(F.count(F.lit(1)).alias("row_count_est")).withColumn("source_table", F.lit(name)) for name, rows in tables.items()]
    store.append(SOURCE_INVENTORY, union_all(known).withColumn("source_schema", F.lit("Store")))
    store.append_values(
        DEFINITION_STORE,
        [{"source_schema": "store", "source_table": name, "original_ddl": _definition(name, rows)} for name, rows in tables.items()],
    )

    run = Transfer.open(spark, store, "driver tables", datasets, f"{root}/target")
    run.assess("STORE")
    run.translate("store")
    run.classify(query_log(spark, folder))
    run.load_batch()
    run.validate_row_counts()
    run.validate_null_rates("nation", tables["nation"])
    run.validate_checksum("supplier", tables["supplier"], ["s_suppkey"])
    run.close()
    return run


def whole_run(spark: SparkSession, folder: str) -> Transfer:
    return _once(_run, spark, folder, (*LOADED, MISSING, "events"))


# One table name in two schemas: customers of even and of odd nations.
_SCHEMAS = {"east": 0, "west": 1}


def _two_schemas(spark: SparkSession, folder: str) -> Transfer:
    """A run over ``east.clients`` and ``west.clients``; the estimate of the second is twice its rows."""
    root = scratch_path(spark, "two-schemas")
    customer = read_table(spark, folder, "customer")
    store = ControlStore(spark, f"{root}/control").create()
    seed_configuration(store)
    datasets = {}
    for schema, odd in _SCHEMAS.items():
        own = customer.filter(F.col("c_nationkey") % 2 == odd)
        datasets[f"{schema}.clients"] = Dataset("clients", f"{root}/text/{schema}", _fields(own), "|")
        own.select(F.concat_ws("|", *[F.col(c).cast("string") for c in own.columns]).alias("value")).write.text(f"{root}/text/{schema}")
        estimate = own.agg((F.count(F.lit(1)) * (1 + odd)).alias("row_count_est"))
        store.append(SOURCE_INVENTORY, estimate.select("row_count_est", F.lit(schema).alias("source_schema"), F.lit("clients").alias("source_table")))
        store.append_values(DEFINITION_STORE, [{"source_schema": schema, "source_table": "clients", "original_ddl": _definition("clients", own)}])
    run = Transfer.open(spark, store, "two schemas", datasets, f"{root}/target")
    for schema in _SCHEMAS:
        run.assess(schema)
    run.translate()
    run.load_batch()
    run.validate_row_counts()
    run.close()
    return run


def run_two_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """Both targets' rows beside the check of each."""
    run = _once(_two_schemas, spark, folder, ("customer",))
    targets = union_all(
        [
            run.target("clients", schema).agg(F.count(F.lit(1)).alias("rows"), F.min("c_custkey").alias("least_key")).withColumn("source_schema", F.lit(schema))
            for schema in _SCHEMAS
        ]
    )
    checks = run.results().select(F.lower("source_schema").alias("source_schema"), "check_name", "source_value", "target_value", "variance_pct", "status")
    owners = run.registry().select("source_schema", "source_table", F.col("status").alias("table_status"))
    return targets.join(checks, "source_schema").join(owners, "source_schema")


def run_targets(spark: SparkSession, folder: str) -> DataFrame:
    """The folder each table's registry row points to, and the rows there."""
    run = whole_run(spark, folder)
    entries = [(row.source_schema, row.source_table, row.target_path) for row in run.registry().collect()]
    rows = [
        run.target(table, schema).agg(F.count(F.lit(1)).alias("rows")).withColumn("source_table", F.lit(table))
        for schema, table, path in entries
        if path
    ]
    owned = F.col("target_path").contains(F.concat(F.lit("/STORE/"), F.upper("source_table"), F.lit("/load=")))
    return run.registry().select("source_table", owned.alias("own_folder")).join(union_all(rows), "source_table", "left")


def run_registry(spark: SparkSession, folder: str) -> DataFrame:
    return whole_run(spark, folder).registry().select(
        "source_table", "status", "row_count_est", F.col("registry_id").isNotNull().alias("has_id"), F.col("registered_at").isNotNull().alias("has_time")
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    return whole_run(spark, folder).log().groupBy("phase", "step_name", "status").agg(
        F.count(F.lit(1)).alias("steps"),
        F.sum("rows_processed").alias("rows_processed"),
        F.sum("tables_processed").alias("tables_processed"),
        F.sum("tables_failed").alias("tables_failed"),
        F.countDistinct("log_id").alias("ids"),
    )


def run_checks(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    owner = run.registry().select("registry_id", "source_table")
    return run.results().join(owner, "registry_id", "left").select(
        "source_table", "check_type", "column_name", "check_name", "source_value", "target_value", "variance_pct", "status"
    )


def run_definitions(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    return run.store.read(TRANSLATION_LOG, run.run_id).select("source_table", "translated_ddl")


def run_labels(spark: SparkSession, folder: str) -> DataFrame:
    run = whole_run(spark, folder)
    labels = run.store.read(CLASSIFICATION_LOG, run.run_id)
    return labels.groupBy("query_category", "confidence").agg(F.count(F.lit(1)).alias("n"))


def run_state(spark: SparkSession, folder: str) -> DataFrame:
    """The run itself, and its tables by state, through the named views."""
    run = whole_run(spark, folder)
    names = create_views(run.store, run.run_id)
    tables = spark.sql("SELECT 'table' AS kind, status, count(*) AS n FROM registry GROUP BY status")
    drop_views(run.store, names)
    runs = run.store.current(RUNS, run.run_id).filter("completed_at IS NOT NULL")
    return tables.unionByName(runs.groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("run")))


QUERIES = {
    "run_registry": run_registry,
    "run_log": run_log,
    "run_checks": run_checks,
    "run_definitions": run_definitions,
    "run_labels": run_labels,
    "run_state": run_state,
    "run_targets": run_targets,
    "run_two_schemas": run_two_schemas,
}

# -- the same in SQL ------------------------------------------------------

_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS source_table, count(*) AS n FROM {t}" for t in (*LOADED, MISSING))
_STEPS = (
    ("ASSESSMENT", "ASSESS_SCHEMA", "5", "NULL", "NULL"),
    ("TRANSLATION", "TRANSLATE_DEFINITIONS", "5", "NULL", "NULL"),
    ("TRANSLATION", "CLASSIFY_QUERIES", "(SELECT count(*) FROM events)", "NULL", "NULL"),
    ("LOAD", "LOAD_BATCH", "NULL", "4", "1"),
    ("VALIDATION", "VALIDATE_ROW_COUNTS", "4", "NULL", "NULL"),
    ("VALIDATION", "VALIDATE_NULL_RATES", "3", "NULL", "NULL"),
    ("VALIDATION", "VALIDATE_CHECKSUM", "1", "NULL", "NULL"),
)


def _log_sql() -> str:
    def row(phase, name, status, steps, rows="NULL", tables="NULL", failed="NULL") -> str:
        numbers = ", ".join(f"CAST({value} AS BIGINT) AS {column}" for value, column in ((steps, "steps"), (rows, "rows_processed"), (tables, "tables_processed"), (failed, "tables_failed"), (steps, "ids")))
        return f"SELECT '{phase}' AS phase, '{name}' AS step_name, '{status}' AS status, {numbers}"

    rows = [row(phase, name, "STARTED", 1) for phase, name, *_ in _STEPS]
    rows += [row(phase, name, "SUCCESS", 1, *numbers) for phase, name, *numbers in _STEPS]
    rows += [
        row("LOAD", "LOAD_TABLE", "STARTED", 5),
        row("LOAD", "LOAD_TABLE", "SUCCESS", 4, f"(SELECT sum(n) FROM ({_COUNTS}) AS c WHERE source_table <> '{MISSING}')"),
        row("LOAD", "LOAD_TABLE", "FAILED", 1),
    ]
    return " UNION ALL ".join(rows)


_SAMPLED = f"(SELECT count(*) FROM supplier WHERE substr(md5(CAST(s_suppkey AS VARCHAR)), 1, 16) < '{round(0.1 * 16**16):016x}')"

_SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}

ORACLE = {
    "run_targets": f"""
        SELECT source_table, CASE WHEN source_table <> '{MISSING}' THEN true END AS own_folder, CASE WHEN source_table <> '{MISSING}' THEN n END AS rows
        FROM ({_COUNTS}) AS c""",
    "run_two_schemas": """
        SELECT source_schema, 'clients' AS source_table, 'VALIDATED' AS table_status, n AS rows, least_key, 'ROW_COUNT:CLIENTS' AS check_name,
               CAST(n * (1 + odd) AS DOUBLE) AS source_value, CAST(n AS DOUBLE) AS target_value, odd * 50.0::DOUBLE AS variance_pct,
               CASE odd WHEN 1 THEN 'FAIL' ELSE 'PASS' END AS status
        FROM (SELECT CASE c_nationkey % 2 WHEN 0 THEN 'east' ELSE 'west' END AS source_schema, c_nationkey % 2 AS odd, count(*) AS n, min(c_custkey) AS least_key
              FROM customer GROUP BY ALL)""",
    "run_registry": f"""
        SELECT source_table, CASE source_table WHEN '{MISSING}' THEN 'TRANSLATED' ELSE 'VALIDATED' END AS status,
               n AS row_count_est, true AS has_id, true AS has_time FROM ({_COUNTS}) AS c""",
    "run_log": _log_sql(),
    "run_checks": f"""
        SELECT source_table, 'ROW_COUNT' AS check_type, CAST(NULL AS VARCHAR) AS column_name, 'ROW_COUNT:' || upper(source_table) AS check_name,
               CAST(n AS DOUBLE) AS source_value, CAST(n AS DOUBLE) AS target_value, CAST(0 AS DOUBLE) AS variance_pct, 'PASS' AS status
        FROM ({_COUNTS}) AS c WHERE source_table <> '{MISSING}'
        UNION ALL SELECT 'nation', 'NULL_RATE', c, 'NULL_RATE:NATION.' || c, 0, 0, 0, 'PASS'
        FROM unnest(['n_nationkey', 'n_name', 'n_regionkey']) AS t(c)
        UNION ALL SELECT 'supplier', 'CHECKSUM', NULL, 'CHECKSUM:SUPPLIER', {_SAMPLED}, {_SAMPLED}, 0,
                  CASE WHEN {_SAMPLED} = 0 THEN 'NO_SAMPLE' ELSE 'PASS' END""",
    "run_definitions": f"""
        SELECT table_name AS source_table, 'CREATE OR REPLACE TABLE ' || table_name || ' (' || string_agg(
                   column_name || ' ' || CASE data_type {' '.join(f"WHEN '{_SQL_TYPES[kind]}' THEN '{left}'" for kind, (_, left) in _DECLARED.items())} END,
                   ', ' ORDER BY ordinal_position) || ') ;' AS translated_ddl
        FROM information_schema.columns WHERE table_name IN ({', '.join(f"'{name}'" for name in (*LOADED, MISSING))}) GROUP BY table_name""",
    "run_labels": f"SELECT query_category, 'HIGH' AS confidence, count(*) AS n FROM ({QUERY_LOG_SQL}) GROUP BY ALL",
    "run_state": """
        SELECT 'table' AS kind, 'VALIDATED' AS status, CAST(4 AS BIGINT) AS n
        UNION ALL SELECT 'table', 'TRANSLATED', 1 UNION ALL SELECT 'run', 'COMPLETED', 1""",
}
