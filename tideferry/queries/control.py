"""Registry, state, log and run reports over the stand-in control tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideferry.operators import incremental, merge, registry as registering, state, steps
from tideferry.operators.load import batch_failures, batch_tally
from tideferry.plans import reports
from tideferry.queries.stand_ins import (
    REGISTRY_SQL,
    RUNS_SQL,
    STEP_LOG_SQL,
    TRANSLATIONS_SQL,
    registry,
    runs,
    step_log,
    translations,
)
from tideferry.sources.shared import scratch_path
from tideferry.sources.tables import read_table


def _inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as source tables; some names lower-cased, some listed twice."""
    customer = read_table(spark, folder, "customer")
    odd = F.col("c_custkey") % 2 == 1

    def cased(name: str):
        return F.when(odd, F.lower(name)).otherwise(F.col(name))

    listed = customer.select(
        cased("c_mktsegment").alias("source_schema"),
        cased("c_name").alias("source_table"),
        F.floor("c_acctbal").cast("bigint").alias("row_count_est"),
        F.col("c_custkey").alias("size_bytes_est"),
        "c_nationkey",
    )
    again = listed.filter("c_nationkey = 3").withColumn("source_table", F.lower("source_table"))
    return listed.unionByName(again).drop("c_nationkey")


def registry_register_new(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").filter("o_totalprice > 450000")
    customer = read_table(spark, folder, "customer")
    big = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    known = customer.join(big, "c_custkey").select(
        F.col("c_mktsegment").alias("source_schema"), F.upper("c_name").alias("source_table")
    )
    return registering.register_new(_inventory(spark, folder), known)


def state_promote(spark: SparkSession, folder: str) -> DataFrame:
    """Registry after the tables with returned lines were marked as translated."""
    current = registry(spark, folder)
    returned = read_table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    processed = returned.select(
        F.concat(F.lit("T_"), F.col("l_orderkey").cast("string")).alias("source_table")
    )
    changed = state.advance(
        state.matching(current, processed, ["source_table"]), status="TRANSLATED"
    )
    columns = ["registry_id", "status", "change_no"]
    events = current.select(*columns).unionByName(changed.select(*columns))
    return state.latest_rows(events, ["registry_id"], ["change_no"])


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.concat(F.lit("t_"), F.col("event_id").cast("string")).alias("source_table"),
        (F.col("event_type") != "error").alias("loaded"),
        F.col("props").alias("error_message"),
    )


def run_overview(spark: SparkSession, folder: str) -> DataFrame:
    """Overview of all runs; events stand in for check results."""
    failed = F.col("event_type") == "error"
    results = read_table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.when(failed, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
    )
    return reports.run_overview(registry(spark, folder), results)


_LOADED_BEFORE = "o_orderdate < timestamp_ntz'2000-06-01 00:00:00'"


def _loaded_orders(orders: DataFrame, lost: str) -> DataFrame:
    return orders.filter(f"{_LOADED_BEFORE} AND NOT ({lost})")


def incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    lost = "o_orderstatus = 'F' AND o_orderdate >= timestamp_ntz'2000-05-15 00:00:00'"
    return incremental.new_rows(
        orders, _loaded_orders(orders, lost), ["o_orderkey"], "o_orderdate", timedelta(days=30)
    ).select("o_orderkey", "o_orderdate", "o_totalprice")


def incremental_load_late(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    loaded = _loaded_orders(orders, "o_orderstatus = 'F' AND o_totalprice < 9000")
    return incremental.new_rows(orders, loaded, ["o_orderkey"]).select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )


def _merged_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as their source has them now, as the table has them, and as the source had them last time.

    The last digit of a key decides: 0 dearer now, 1 gone, 2 new, 3 and some of 5 changed or lost in
    the table by itself; a few have no key. Some dearer ones have reached the table already.
    """
    orders = read_table(spark, folder, "orders")
    key, price, digit = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderkey") % 10
    keyless = F.when(key % 50 != 7, key)
    source = orders.filter(digit != 1).withColumn("o_totalprice", F.when(digit == 0, price + 1).when(key % 50 == 7, price + 2).otherwise(price))
    last = orders.filter(digit != 2)
    late = (digit == 0) & (F.col("o_orderstatus") == "O")
    table = last.filter((digit != 5) | (F.col("o_orderstatus") != "F")).withColumn("o_totalprice", F.when(digit == 3, price - 1).when(late, price + 1).otherwise(price))
    return tuple(rows.withColumn("o_orderkey", keyless) for rows in (source, table, last))


def incremental_changes(spark: SparkSession, folder: str) -> DataFrame:
    source, table, last = _merged_sides(spark, folder)
    return merge.row_changes(source, table, ["o_orderkey"], last)


def incremental_merge(spark: SparkSession, folder: str) -> DataFrame:
    """A table of old orders, merged with what their source holds now."""
    source, _, last = _merged_sides(spark, folder)
    table = merge.MergedTable(spark, scratch_path(spark, "merged"), ["o_orderkey"], source.schema, 16)
    table.merge(last)
    table.merge(source)
    return table.rows()


def _paired_log(spark: SparkSession, folder: str) -> DataFrame:
    """A log of starts and ends: half of the events start one of three steps, the others end one."""
    kind = F.col("event_type")
    status = F.when(kind.isin("signup", "view"), "STARTED").when(kind == "error", "FAILED").otherwise("SUCCESS")
    return read_table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        # One run has a third of all rows.
        F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("run_id"),
        F.when(F.col("value") < 5, "LOAD").otherwise("VALIDATION").alias("phase"),
        F.concat(F.lit("STEP_"), (F.col("event_id") % 3).cast("string")).alias("step_name"),
        status.alias("status"),
        F.when(status != "STARTED", F.floor(F.col("value") * 100).cast("bigint")).alias("rows_processed"),
        F.col("ts").alias("logged_at"),
    )


QUERIES = {
    "step_pairs": lambda spark, folder: steps.step_pairs(_paired_log(spark, folder)),
    "open_steps": lambda spark, folder: steps.open_steps(_paired_log(spark, folder)),
    "inventory_by_schema": lambda spark, folder: registering.inventory_of(
        _inventory(spark, folder), "Building"
    ),
    "registry_register_new": registry_register_new,
    "registry_listing": lambda spark, folder: reports.registry_listing(registry(spark, folder)),
    "pending_work": lambda spark, folder: registering.pending_work(
        registry(spark, folder)
    ).select("registry_id", "priority", "source_table"),
    "latest_definition": lambda spark, folder: registering.latest_definition(
        translations(spark, folder)
    ).select(F.upper("source_table").alias("source_table"), "translation_id", "original_ddl"),
    "latest_state": lambda spark, folder: state.latest_value(
        step_log(spark, folder), ["run_id"], "status", ["logged_at", "seq"]
    ),
    "state_promote": state_promote,
    "latest_run": lambda spark, folder: reports.latest_run(runs(spark, folder)),
    "run_picker": lambda spark, folder: reports.run_picker(runs(spark, folder)),
    "run_kpis": lambda spark, folder: reports.run_kpis(registry(spark, folder)),
    "run_overview": run_overview,
    "status_view": lambda spark, folder: reports.status_view(
        registry(spark, folder), runs(spark, folder)
    ),
    "status_summary": lambda spark, folder: reports.status_summary(registry(spark, folder)),
    "recent_activity": lambda spark, folder: reports.recent_activity(step_log(spark, folder)),
    "audit_trail": lambda spark, folder: reports.audit_trail(step_log(spark, folder)),
    "log_by_phase": lambda spark, folder: reports.log_by_phase(
        step_log(spark, folder), ["ASSESSMENT", "LOAD"]
    ),
    "log_phases": lambda spark, folder: reports.log_phases(step_log(spark, folder)),
    "log_kpis": lambda spark, folder: reports.log_kpis(step_log(spark, folder)),
    "rows_processed_total": lambda spark, folder: reports.rows_processed_total(
        step_log(spark, folder)
    ),
    "failed_steps": lambda spark, folder: reports.failed_steps(step_log(spark, folder)),
    "step_durations": lambda spark, folder: reports.step_durations(step_log(spark, folder)),
    "batch_load_summary": lambda spark, folder: batch_tally(_outcomes(spark, folder), ["run_id"]),
    "batch_load_failures": lambda spark, folder: batch_failures(
        _outcomes(spark, folder), ["run_id"]
    ),
    "incremental_changes": incremental_changes,
    "incremental_load": incremental_load,
    "incremental_load_late": incremental_load_late,
    "incremental_merge": incremental_merge,
}

# -- the same in SQL ------------------------------------------------------

_INVENTORY = """(
    WITH listed AS (
        SELECT CASE WHEN c_custkey % 2 = 1 THEN lower(c_mktsegment) ELSE c_mktsegment END AS source_schema,
               CASE WHEN c_custkey % 2 = 1 THEN lower(c_name) ELSE c_name END AS source_table,
               CAST(floor(c_acctbal) AS BIGINT) AS row_count_est, c_custkey AS size_bytes_est, c_nationkey
        FROM customer)
    SELECT source_schema, source_table, row_count_est, size_bytes_est FROM listed
    UNION ALL
    SELECT source_schema, lower(source_table), row_count_est, size_bytes_est FROM listed
    WHERE c_nationkey = 3)"""

_LOG_LIST = "run_id, seq, phase, step_name, status, rows_processed, logged_at, error_message"


def _new_orders(lost: str, bound: str) -> str:
    return f"""
        WITH loaded AS (SELECT * FROM orders
                        WHERE o_orderdate < TIMESTAMP '2000-06-01 00:00:00' AND NOT ({lost}))
        SELECT o_orderkey, o_orderdate, o_totalprice FROM orders o
        WHERE {bound} AND NOT EXISTS (SELECT 1 FROM loaded l WHERE l.o_orderkey = o.o_orderkey)"""


_FOLLOWED = """
    SELECT *, lead(seq) OVER w AS ended_seq, lead(status) OVER w AS next_status, lead(rows_processed) OVER w AS next_rows, lead(logged_at) OVER w AS ended_at
    FROM (SELECT event_id AS seq, CASE user_id % 3 WHEN 0 THEN 0 ELSE user_id END AS run_id, CASE WHEN value < 5 THEN 'LOAD' ELSE 'VALIDATION' END AS phase,
                 'STEP_' || CAST(event_id % 3 AS VARCHAR) AS step_name, ts AS logged_at,
                 CASE WHEN event_type IN ('signup', 'view') THEN 'STARTED' WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                 CASE WHEN event_type NOT IN ('signup', 'view') THEN CAST(floor(value * 100) AS BIGINT) END AS rows_processed
          FROM events) AS log
    WINDOW w AS (PARTITION BY run_id, phase, step_name ORDER BY seq)"""

ORACLE = {
    "step_pairs": f"""
        SELECT run_id, phase, step_name, seq AS started_seq, ended_seq, next_status AS status, next_rows AS rows_processed, logged_at AS started_at, ended_at,
               CAST(floor(floor((epoch_us(ended_at) - epoch_us(logged_at)) / 1000.0) / 1000.0 + 0.5) AS BIGINT) AS seconds
        FROM ({_FOLLOWED}) AS f WHERE status = 'STARTED' AND next_status <> 'STARTED'""",
    "open_steps": f"""
        SELECT run_id, phase, step_name, seq AS started_seq, logged_at AS started_at
        FROM ({_FOLLOWED}) AS f WHERE status = 'STARTED' AND coalesce(next_status, 'STARTED') = 'STARTED'""",
    "inventory_by_schema": f"SELECT * FROM {_INVENTORY} WHERE upper(source_schema) = 'BUILDING'",
    "registry_register_new": f"""
        SELECT min(source_schema) AS source_schema, min(source_table) AS source_table,
               'TARGET' AS target_schema, upper(source_table) AS target_table,
               min(row_count_est) AS row_count_est, min(size_bytes_est) AS size_bytes_est,
               'PENDING' AS status
        FROM {_INVENTORY}
        WHERE upper(source_table) NOT IN (
            SELECT upper(c_name) FROM customer JOIN orders ON c_custkey = o_custkey
            WHERE o_totalprice > 450000)
        GROUP BY upper(source_schema), upper(source_table)""",
    "registry_listing": f"SELECT run_id, source_table, target_table, status FROM ({REGISTRY_SQL})",
    "pending_work": f"""
        SELECT registry_id, priority, source_table FROM ({REGISTRY_SQL})
        WHERE status = 'TRANSLATED' ORDER BY priority, source_table""",
    "latest_definition": f"""
        SELECT upper(source_table) AS source_table, translation_id, original_ddl FROM (
            SELECT *, row_number() OVER (PARTITION BY upper(source_table)
                                         ORDER BY translated_at DESC, translation_id DESC) AS rn
            FROM ({TRANSLATIONS_SQL})) WHERE rn = 1""",
    "latest_state": f"""
        SELECT run_id, status, changes FROM (
            SELECT run_id, status, count(*) OVER (PARTITION BY run_id) AS changes,
                   row_number() OVER (PARTITION BY run_id ORDER BY logged_at DESC, seq DESC) AS rn
            FROM ({STEP_LOG_SQL})) WHERE rn = 1""",
    "state_promote": f"""
        SELECT registry_id, CASE WHEN hit THEN 'TRANSLATED' ELSE status END AS status,
               CAST(CASE WHEN hit THEN 1 ELSE 0 END AS BIGINT) AS change_no
        FROM (SELECT *, registry_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS hit
              FROM ({REGISTRY_SQL}))""",
    "latest_run": f"SELECT * FROM ({RUNS_SQL}) ORDER BY started_at DESC, run_id DESC LIMIT 1",
    "run_picker": f"""
        SELECT run_id, run_name || ' (' || CAST(run_id AS VARCHAR) || ')' AS display
        FROM ({RUNS_SQL}) ORDER BY started_at DESC""",
    "run_kpis": f"""
        SELECT run_id, count(*) AS total_tables,
               count(*) FILTER (WHERE status IN ('LOADED', 'VALIDATED')) AS loaded_tables,
               count(*) FILTER (WHERE status = 'VALIDATED') AS validated_tables
        FROM ({REGISTRY_SQL}) GROUP BY run_id""",
    "run_overview": f"""
        SELECT t.run_id, total_tables, loaded_tables, validated_tables, coalesce(rate, 0.0) AS pass_rate
        FROM (SELECT run_id, count(*) AS total_tables,
                     count(*) FILTER (WHERE status IN ('LOADED', 'VALIDATED')) AS loaded_tables,
                     count(*) FILTER (WHERE status = 'VALIDATED') AS validated_tables
              FROM ({REGISTRY_SQL}) GROUP BY run_id) t
        LEFT JOIN (SELECT user_id, round(count(*) FILTER (WHERE event_type <> 'error')
                          / count(*) * 100.0, 1) AS rate FROM events GROUP BY user_id) c
          ON t.run_id = c.user_id""",
    "status_view": f"""
        SELECT r.run_name, r.status AS run_status, t.source_schema, t.source_table, t.target_schema,
               t.target_table, t.status AS table_status, t.row_count_est, t.updated_at
        FROM ({REGISTRY_SQL}) t LEFT JOIN ({RUNS_SQL}) r ON t.run_id = r.run_id
        ORDER BY t.priority, t.source_table""",
    "status_summary": f"""
        SELECT status, count(*) AS table_count, CAST(sum(row_count_est) AS BIGINT) AS total_rows_est
        FROM ({REGISTRY_SQL}) GROUP BY status""",
    "recent_activity": f"""
        SELECT phase, step_name, status, rows_processed, duration_secs, error_message, logged_at
        FROM ({STEP_LOG_SQL}) ORDER BY logged_at DESC, seq DESC LIMIT 50""",
    "audit_trail": f"SELECT {_LOG_LIST} FROM ({STEP_LOG_SQL}) ORDER BY run_id, logged_at, seq",
    "log_by_phase": f"""
        SELECT {_LOG_LIST} FROM ({STEP_LOG_SQL}) WHERE phase IN ('ASSESSMENT', 'LOAD')
        ORDER BY run_id, logged_at, seq""",
    "log_phases": f"SELECT DISTINCT phase FROM ({STEP_LOG_SQL}) ORDER BY phase",
    "log_kpis": f"""
        SELECT run_id, count(*) AS total_steps,
               count(*) FILTER (WHERE status = 'SUCCESS') AS successful_steps,
               count(*) FILTER (WHERE status = 'FAILED') AS failed_steps
        FROM ({STEP_LOG_SQL}) GROUP BY run_id""",
    "rows_processed_total": f"""
        SELECT CAST(coalesce(sum(rows_processed), 0) AS BIGINT) AS total_rows FROM ({STEP_LOG_SQL})""",
    "failed_steps": f"""
        SELECT run_id, seq, phase, step_name, error_message FROM ({STEP_LOG_SQL})
        WHERE status = 'FAILED'""",
    "step_durations": f"""
        SELECT run_id, CAST(floor(floor((epoch_us(max(logged_at) FILTER (WHERE status <> 'STARTED'))
               - epoch_us(min(logged_at) FILTER (WHERE status = 'STARTED'))) / 1000.0) / 1000.0 + 0.5)
               AS BIGINT) AS duration_secs
        FROM ({STEP_LOG_SQL}) GROUP BY run_id""",
    "batch_load_summary": """
        SELECT user_id AS run_id, count(*) FILTER (WHERE event_type <> 'error') AS tables_loaded,
               count(*) FILTER (WHERE event_type = 'error') AS tables_failed,
               min(message) AS first_failure, max(message) AS last_failure
        FROM (SELECT *, CASE WHEN event_type = 'error'
                     THEN 't_' || CAST(event_id AS VARCHAR) || ': ' || props END AS message FROM events)
        GROUP BY user_id""",
    "batch_load_failures": """
        SELECT user_id AS run_id, 't_' || CAST(event_id AS VARCHAR) || ': ' || props AS failure
        FROM events WHERE event_type = 'error'""",
    "incremental_changes": """
        SELECT o_orderkey, CASE o_orderkey % 10 WHEN 2 THEN 'INSERTED' WHEN 1 THEN 'DELETED' WHEN 0 THEN 'UPDATED' ELSE 'DRIFTED' END AS change,
               o_orderkey % 10 <> 0 OR o_orderstatus <> 'O' AS written
        FROM orders WHERE o_orderkey % 10 IN (0, 1, 2, 3) OR (o_orderkey % 10 = 5 AND o_orderstatus = 'F')
        UNION ALL SELECT NULL, 'UPDATED', true WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 50 = 7)""",
    "incremental_merge": """
        SELECT CASE WHEN o_orderkey % 50 <> 7 THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
               o_totalprice + CASE WHEN o_orderkey % 10 = 0 THEN 1 WHEN o_orderkey % 50 = 7 THEN 2 ELSE 0 END AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderkey % 10 <> 1""",
    "incremental_load": _new_orders(
        "o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-05-15 00:00:00'",
        "o_orderdate >= (SELECT max(o_orderdate) FROM loaded) - INTERVAL 30 DAY",
    ),
    "incremental_load_late": _new_orders("o_orderstatus = 'F' AND o_totalprice < 9000", "true"),
}
