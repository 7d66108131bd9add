"""Reconciliation, its listings, and the keyed checksum."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideferry.model import VALIDATION_CONFIG
from tideferry.functions.numeric import as_whole_number
from tideferry.operators import checksum, reconcile
from tideferry.plans import reports
from tideferry.queries.stand_ins import ALL, REGISTRY_SQL, registry
from tideferry.sources.tables import read_table, read_tables

# -- inputs ---------------------------------------------------------------

SOURCES = ("orders", "lineitem", "customer", "part", "supplier", "nation", "region", "events")

# Rows a target kept, for targets that lost some on the way.
KEPT = {"orders": "o_totalprice >= 20000", "lineitem": "l_quantity < 50", "events": "event_type <> 'error'"}

# Columns that turned null on the way: (source condition, target condition).
NULLED = {
    "events": {
        "event_type": ("event_type = 'error'", "event_type = 'error'"),
        "value": ("value < 1", "value < 1 OR event_type = 'click'"),
        "props": (None, "value > 45"),
    },
    "orders": {
        "o_totalprice": ("o_totalprice < 5000", "o_totalprice < 7000"),
        "o_orderpriority": (None, "o_orderpriority = '5-LOW' AND o_orderstatus = 'P'"),
    },
    "customer": {},
}

COLUMNS = {
    "events": "event_id ts user_id event_type value props",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
}

# Configuration rows: id, type, active, fraction.
CONFIG = (
    ("1", "ROW_COUNT", False, 0.5),
    ("2", "ROW_COUNT", True, 0.001),
    ("3", "NULL_RATE", True, 0.01),
    ("4", "NULL_RATE", True, 0.9),
    ("5", "CHECKSUM", True, 0.0),
)


def config(spark: SparkSession) -> DataFrame:
    rows = [(key, kind.title(), kind, active, share, None) for key, kind, active, share in CONFIG]
    return spark.createDataFrame(rows, VALIDATION_CONFIG.schema)


def _counts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    source = read_tables(spark, folder, SOURCES)
    target = {
        name.upper(): rows.filter(KEPT[name]) if name in KEPT else rows
        for name, rows in source.items()
    }
    target["LABELS"] = read_table(spark, folder, "labels")
    # A table that never arrived.
    source["benchmark"] = read_table(spark, folder, "benchmark")
    return reconcile.table_counts(source), reconcile.table_counts(target)


def row_count_reconcile(spark: SparkSession, folder: str, threshold=reconcile.ROW_COUNT_TOLERANCE) -> DataFrame:
    return reconcile.reconcile_row_counts(*_counts(spark, folder), threshold)


def row_count_reconcile_config(spark: SparkSession, folder: str) -> DataFrame:
    threshold = reconcile.configured_threshold(config(spark), reconcile.ROW_COUNT, 5.0)
    return row_count_reconcile(spark, folder, threshold)


def _nulled(rows: DataFrame, conditions: dict, side: int) -> DataFrame:
    columns = {
        name: F.when(~F.expr(sides[side]), F.col(name))
        for name, sides in conditions.items()
        if sides[side]
    }
    return rows.select(*[columns.get(c, F.col(c)).alias(c) for c in rows.columns])


def null_rate_reconcile(spark: SparkSession, folder: str, threshold=reconcile.NULL_RATE_TOLERANCE) -> DataFrame:
    tables = read_tables(spark, folder, NULLED)
    pairs = {
        name: (_nulled(rows, NULLED[name], 0), _nulled(rows, NULLED[name], 1))
        for name, rows in tables.items()
    }
    return reconcile.reconcile_null_rates_of(pairs, threshold)


def null_rate_reconcile_config(spark: SparkSession, folder: str) -> DataFrame:
    threshold = reconcile.configured_threshold(config(spark), reconcile.NULL_RATE, 1.0)
    return null_rate_reconcile(spark, folder, threshold)


def results(spark: SparkSession, folder: str) -> DataFrame:
    return row_count_reconcile(spark, folder).unionByName(null_rate_reconcile(spark, folder))


def null_rate_display(spark: SparkSession, folder: str) -> DataFrame:
    return null_rate_reconcile(spark, folder).select(
        "check_name",
        as_whole_number(F.col("source_value")).alias("source_value"),
        as_whole_number(F.col("target_value")).alias("target_value"),
        "variance_pct",
        "status",
    )


_LISTED = ("check_name", "source_value", "target_value", "variance_pct", "status")


_CHECKED_AT = "TIMESTAMP '2024-03-01 08:00:00'"


def validation_view(spark: SparkSession, folder: str) -> DataFrame:
    table_check = F.col("check_type") == reconcile.ROW_COUNT
    owned = results(spark, folder).withColumn(
        "registry_id", F.when(table_check, F.col("source_value").cast("bigint"))
    )
    owned = owned.withColumn("checked_at", F.expr(_CHECKED_AT.replace("TIMESTAMP", "timestamp_ntz")))
    return reports.validation_view(owned, registry(spark, folder))


def _changed_orders(orders: DataFrame) -> DataFrame:
    dearer = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    kept = orders.filter("o_totalprice >= 30000").withColumn(
        "o_totalprice",
        F.when(dearer, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    extra = orders.filter("o_totalprice > 470000").withColumn(
        "o_orderkey", F.col("o_orderkey") + 1_000_000_000_000
    )
    return kept.unionByName(extra)


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return checksum.compare_sample(orders, _changed_orders(orders), ["o_orderkey"])


def _compared_typed(spark: SparkSession, folder: str) -> DataFrame:
    """The same orders, moved to a target with decimal keys and upper-case columns."""
    orders = read_table(spark, folder, "orders")
    target = _changed_orders(orders).withColumn("o_orderkey", F.col("o_orderkey").cast("decimal(20,0)"))
    target = target.withColumnsRenamed({name: name.upper() for name in target.columns})
    return checksum.compare_sample(orders, target, ["o_orderkey"])


def _compared_unconvertible(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose keys are texts, a quarter of them no numbers, moved to a target that lost those."""
    orders = read_table(spark, folder, "orders")
    lettered = F.col("o_orderkey") % 4 == 0
    key = F.col("o_orderkey").cast("string")
    source = orders.withColumn("o_orderkey", F.when(lettered, F.concat(F.lit("x"), key)).otherwise(key))
    return checksum.compare_sample(source, orders.filter(~lettered), ["o_orderkey"])


def _partly_changed_orders(orders: DataFrame) -> DataFrame:
    """Orders that lost, changed and gained rows in a few places."""
    key = F.col("o_orderkey")
    dearer = F.when(key.between(5000, 5020), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = orders.filter(~key.between(1000, 1100)).withColumn("o_totalprice", dearer)
    return kept.unionByName(orders.filter(key.between(300, 303))).unionByName(orders.filter(key < 10).withColumn("o_orderkey", -key))


def checksum_locate(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return checksum.locate(orders, _partly_changed_orders(orders), ["o_orderkey"], few=1000)


QUERIES = {
    "checksum_locate": checksum_locate,
    "sample_checksum_unconvertible": lambda spark, folder: checksum.sample_checksum("orders", _compared_unconvertible(spark, folder)),
    "row_count_reconcile": row_count_reconcile,
    "row_count_reconcile_config": row_count_reconcile_config,
    "null_rate_reconcile": null_rate_reconcile,
    "null_rate_reconcile_config": null_rate_reconcile_config,
    "null_rate_display": null_rate_display,
    "union_table_counts": lambda spark, folder: reconcile.table_counts(
        read_tables(spark, folder, ALL)
    ).orderBy("table_name"),
    "check_pass_fail": lambda spark, folder: reconcile.pass_fail(results(spark, folder)),
    "pass_rate": lambda spark, folder: reports.pass_rate(results(spark, folder)),
    "validation_ranked": lambda spark, folder: reconcile.ranked(
        results(spark, folder).select(*_LISTED)
    ),
    "checks_row_count": lambda spark, folder: reconcile.row_count_checks(results(spark, folder)),
    "checks_table_level": lambda spark, folder: reconcile.table_level(
        results(spark, folder).select(*_LISTED)
    ),
    "checks_column_level": lambda spark, folder: reconcile.column_level(
        results(spark, folder).select(*_LISTED)
    ),
    "null_rate_tables": lambda spark, folder: reconcile.null_rate_tables(results(spark, folder)),
    "null_rate_columns": lambda spark, folder: reconcile.null_rate_columns(results(spark, folder)),
    "validation_view": validation_view,
    "sample_checksum": lambda spark, folder: checksum.sample_checksum(
        "orders", _compared(spark, folder)
    ),
    "sample_checksum_typed": lambda spark, folder: checksum.sample_checksum(
        "orders", _compared_typed(spark, folder)
    ),
    "sample_checksum_differences": lambda spark, folder: checksum.differences(
        _compared(spark, folder)
    ),
}

# -- the same in SQL ------------------------------------------------------


def _round4(value: str) -> str:
    return f"floor(({value}) * 10000.0 + 0.5) / 10000.0"


def _row_counts_sql(threshold: str) -> str:
    source = " UNION ALL ".join(f"SELECT '{t.upper()}' AS tbl, count(*) AS s FROM {t}" for t in (*SOURCES, "benchmark"))
    target = " UNION ALL ".join(
        f"SELECT '{t.upper()}' AS tbl, count(*) AS t FROM {t} WHERE {KEPT.get(t, 'true')}"
        for t in (*SOURCES, "labels")
    )
    return f"""
    SELECT 'ROW_COUNT' AS check_type, tbl AS table_name, CAST(NULL AS VARCHAR) AS column_name,
           'ROW_COUNT:' || tbl AS check_name, CAST(s AS DOUBLE) AS source_value,
           CAST(t AS DOUBLE) AS target_value, {_round4('v')} AS variance_pct,
           CASE WHEN v > {threshold} THEN 'FAIL' ELSE 'PASS' END AS status,
           CASE WHEN s = 0 THEN 'NO_SOURCE' WHEN absent THEN 'NO_TARGET' END AS note
    FROM (SELECT tbl, s, t, absent, CASE WHEN s > 0 THEN abs(s - t) / s * 100.0 ELSE 0.0 END AS v
          FROM (SELECT coalesce(tgt.tbl, src.tbl) AS tbl, coalesce(s, 0) AS s, coalesce(t, 0) AS t, t IS NULL AS absent
                FROM ({target}) tgt FULL JOIN ({source}) src ON tgt.tbl = src.tbl))"""


def _null_rates_sql(threshold: str) -> str:
    def rate(conditions: dict, column: str, side: int) -> str:
        nulled = conditions.get(column, (None, None))[side] or "false"
        return _round4(
            f"coalesce(count(*) FILTER (WHERE ({nulled}) OR {column} IS NULL) / nullif(count(*), 0) * 100.0, 0.0)"
        )

    rows = " UNION ALL ".join(
        f"SELECT '{table.upper()}' AS tbl, '{column}' AS col, "
        f"{rate(conditions, column, 0)} AS s, {rate(conditions, column, 1)} AS t FROM {table}"
        for table, conditions in NULLED.items()
        for column in COLUMNS[table].split()
    )
    return f"""
    SELECT 'NULL_RATE' AS check_type, tbl AS table_name, col AS column_name,
           'NULL_RATE:' || tbl || '.' || col AS check_name, s AS source_value, t AS target_value,
           d AS variance_pct, CASE WHEN d > {threshold} THEN 'FAIL' ELSE 'PASS' END AS status,
           CAST(NULL AS VARCHAR) AS note
    FROM (SELECT *, {_round4('abs(t - s)')} AS d FROM ({rows}))"""


def _configured(kind: str) -> str:
    values = ", ".join(f"('{k}', '{t}', {a}, {s})" for k, t, a, s in CONFIG)
    return (
        f"(SELECT arg_min(share, id) * 100.0 FROM (VALUES {values}) c(id, kind, active, share) "
        f"WHERE active AND kind = '{kind}')"
    )


_RESULTS = f"({_row_counts_sql('5.0')} UNION ALL {_null_rates_sql('1.0')})"
_LIST = ", ".join(_LISTED)

_COMPARED = """(
    SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END AS source_rows,
           CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END AS target_rows,
           CASE WHEN t.o_orderkey IS NULL THEN 'MISSING_IN_TARGET'
                WHEN s.o_orderkey IS NULL THEN 'EXTRA_IN_TARGET'
                WHEN s.o_totalprice = t.o_totalprice THEN 'MATCH' ELSE 'CHANGED' END AS status
    FROM orders s FULL JOIN (
        SELECT o_orderkey, o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
               THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_totalprice >= 30000
        UNION ALL
        SELECT o_orderkey + 1000000000000, o_totalprice FROM orders WHERE o_totalprice > 470000
    ) t ON s.o_orderkey = t.o_orderkey
    WHERE substr(md5(CAST(coalesce(s.o_orderkey, t.o_orderkey) AS VARCHAR)), 1, 16) < '"""+ f"{round(0.1 * 16**16):016x}" + """')"""

ORACLE = {
    "row_count_reconcile": _row_counts_sql("5.0"),
    "row_count_reconcile_config": _row_counts_sql(_configured("ROW_COUNT")),
    "null_rate_reconcile": _null_rates_sql("1.0"),
    "null_rate_reconcile_config": _null_rates_sql(_configured("NULL_RATE")),
    "null_rate_display": f"""
        SELECT check_name, CAST(floor(source_value + 0.5) AS INTEGER) AS source_value,
               CAST(floor(target_value + 0.5) AS INTEGER) AS target_value, variance_pct, status
        FROM ({_null_rates_sql('1.0')})""",
    "union_table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ALL
    ),
    "check_pass_fail": f"""
        SELECT check_type, count(*) FILTER (WHERE status = 'PASS') AS passed,
               count(*) FILTER (WHERE status = 'FAIL') AS failed
        FROM {_RESULTS} GROUP BY check_type""",
    "pass_rate": f"""
        SELECT round(count(*) FILTER (WHERE status = 'PASS') / count(*) * 100.0, 1) AS pass_rate
        FROM {_RESULTS}""",
    "validation_ranked": f"""
        SELECT {_LIST} FROM {_RESULTS}
        ORDER BY CASE status WHEN 'FAIL' THEN 0 WHEN 'WARNING' THEN 1 ELSE 2 END, check_name""",
    "checks_row_count": f"""
        SELECT table_name, CAST(CAST(source_value AS BIGINT) AS VARCHAR) AS source_rows,
               CAST(CAST(target_value AS BIGINT) AS VARCHAR) AS target_rows, variance_pct, status
        FROM {_RESULTS} WHERE check_type = 'ROW_COUNT'""",
    "checks_table_level": f"SELECT {_LIST} FROM {_RESULTS} WHERE check_name NOT LIKE '%.%'",
    "checks_column_level": f"SELECT {_LIST} FROM {_RESULTS} WHERE check_name LIKE '%.%'",
    "null_rate_tables": f"SELECT DISTINCT table_name FROM {_RESULTS} WHERE check_type = 'NULL_RATE'",
    "null_rate_columns": f"""
        SELECT table_name, column_name, target_value AS null_rate, variance_pct, status
        FROM {_RESULTS} WHERE check_type = 'NULL_RATE'""",
    "validation_view": f"""
        SELECT r.source_table, v.check_name, v.status, v.source_value, v.target_value, v.variance_pct,
               {_CHECKED_AT} AS checked_at
        FROM {_RESULTS} v LEFT JOIN ({REGISTRY_SQL}) r
          ON v.check_type = 'ROW_COUNT' AND r.registry_id = CAST(v.source_value AS BIGINT)""",
    "sample_checksum": f"""
        SELECT 'CHECKSUM' AS check_type, 'ORDERS' AS table_name, CAST(NULL AS VARCHAR) AS column_name,
               'CHECKSUM:ORDERS' AS check_name, CAST(n AS DOUBLE) AS source_value,
               CAST(m AS DOUBLE) AS target_value,
               {_round4('coalesce((n - m) / nullif(n, 0) * 100.0, 0.0)')} AS variance_pct,
               CASE WHEN n > m THEN 'FAIL' ELSE 'PASS' END AS status, CAST(NULL AS VARCHAR) AS note
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE status = 'MATCH') AS m FROM {_COMPARED})""",
    "sample_checksum_differences": f"""
        SELECT o_orderkey, CAST(NULL AS VARCHAR) AS unconverted, CAST(source_rows AS BIGINT) AS source_rows,
               CAST(target_rows AS BIGINT) AS target_rows, status
        FROM {_COMPARED} WHERE status <> 'MATCH'""",
}

ORACLE["sample_checksum_typed"] = ORACLE["sample_checksum"]

_SAMPLE_BOUND = f"{round(0.1 * 16**16):016x}"
ORACLE["sample_checksum_unconvertible"] = f"""
    SELECT 'CHECKSUM' AS check_type, 'ORDERS' AS table_name, CAST(NULL AS VARCHAR) AS column_name, 'CHECKSUM:ORDERS' AS check_name,
           CAST(n AS DOUBLE) AS source_value, CAST(m AS DOUBLE) AS target_value, {_round4('coalesce((n - m) / nullif(n, 0) * 100.0, 0.0)')} AS variance_pct,
           CASE WHEN n > m THEN 'FAIL' ELSE 'PASS' END AS status, CAST(NULL AS VARCHAR) AS note
    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE NOT lettered) AS m
          FROM (SELECT o_orderkey % 4 = 0 AS lettered, CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS k FROM orders)
          WHERE substr(md5(k), 1, 16) < '{_SAMPLE_BOUND}')"""
ORACLE["checksum_locate"] = """
    SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, CAST(NULL AS VARCHAR) AS unconverted,
           coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows,
           CASE WHEN t.n IS NULL THEN 'MISSING_IN_TARGET' WHEN s.n IS NULL THEN 'EXTRA_IN_TARGET' ELSE 'CHANGED' END AS status
    FROM (SELECT o_orderkey, count(*) AS n, sum(o_totalprice) AS price FROM orders GROUP BY o_orderkey) s
    FULL JOIN (SELECT o_orderkey, count(*) AS n, sum(o_totalprice) AS price FROM (
            SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey BETWEEN 5000 AND 5020 THEN 1 ELSE 0 END AS o_totalprice
            FROM orders WHERE o_orderkey NOT BETWEEN 1000 AND 1100
            UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 300 AND 303
            UNION ALL SELECT -o_orderkey, o_totalprice FROM orders WHERE o_orderkey < 10)
          GROUP BY o_orderkey) t ON s.o_orderkey = t.o_orderkey
    WHERE s.n IS DISTINCT FROM t.n OR s.price <> t.price"""
