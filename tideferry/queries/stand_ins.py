"""Control tables derived from the driver tables, in Spark and in SQL.

Control tables are small in practice. Deriving them from fact tables lets the
reports run over data that grows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideferry.functions.frames import dealt
from tideferry.sources.tables import read_table

ALL = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_SLOT = re.compile(r"\{(\w+)\}")


def fill(template: str, **slots: Column) -> Column:
    """A template with ``{slots}`` as one concatenation of columns."""
    pieces = _SLOT.split(template)
    return F.concat(
        *[F.lit(p) if i % 2 == 0 else slots[p].cast("string") for i, p in enumerate(pieces) if p]
    )


def fill_sql(template: str, **slots: str) -> str:
    pieces = _SLOT.split(template)
    return " || ".join(
        "'" + p.replace("'", "''") + "'" if i % 2 == 0 else f"CAST({slots[p]} AS VARCHAR)"
        for i, p in enumerate(pieces)
        if p
    )


def _choice(column: str, cases: dict[str, str], default: str) -> Column:
    chosen = F
    for value, name in cases.items():
        chosen = chosen.when(F.col(column) == value, F.lit(name))
    return chosen.otherwise(F.lit(default))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    finished = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("run_id"),
        F.col("c_name").alias("run_name"),
        F.when(finished, F.lit("COMPLETED")).otherwise(F.lit("IN_PROGRESS")).alias("status"),
        F.expr(
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey)"
        ).alias("started_at"),
    )


RUNS_SQL = """
    SELECT c_custkey AS run_id, c_name AS run_name,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'COMPLETED'
                ELSE 'IN_PROGRESS' END AS status,
           TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL 1 SECOND AS started_at
    FROM customer"""


def registry(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("registry_id"),
        F.col("o_custkey").alias("run_id"),
        F.lit("src").alias("source_schema"),
        fill("t_{key}", key=F.col("o_orderkey")).alias("source_table"),
        F.lit("TARGET").alias("target_schema"),
        fill("T_{key}", key=F.col("o_orderkey")).alias("target_table"),
        F.floor("o_totalprice").cast("bigint").alias("row_count_est"),
        F.left("o_orderpriority", F.lit(1)).cast("bigint").alias("priority"),
        _choice("o_orderstatus", {"P": "TRANSLATED", "O": "LOADED"}, "VALIDATED").alias("status"),
        F.col("o_orderdate").alias("updated_at"),
        F.lit(0).cast("bigint").alias("change_no"),
    )


REGISTRY_SQL = """
    SELECT o_orderkey AS registry_id, o_custkey AS run_id, 'src' AS source_schema,
           't_' || CAST(o_orderkey AS VARCHAR) AS source_table, 'TARGET' AS target_schema,
           'T_' || CAST(o_orderkey AS VARCHAR) AS target_table,
           CAST(floor(o_totalprice) AS BIGINT) AS row_count_est,
           CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
           CASE o_orderstatus WHEN 'P' THEN 'TRANSLATED' WHEN 'O' THEN 'LOADED'
                ELSE 'VALIDATED' END AS status,
           o_orderdate AS updated_at, CAST(0 AS BIGINT) AS change_no
    FROM orders"""


def step_log(spark: SparkSession, folder: str) -> DataFrame:
    started, failed = F.col("event_type") == "signup", F.col("event_type") == "error"
    phases = {"signup": "ASSESSMENT", "view": "TRANSLATION", "click": "LOAD"}
    return read_table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("run_id"),
        _choice("event_type", phases, "VALIDATION").alias("phase"),
        F.concat(F.lit("STEP_"), F.upper("event_type")).alias("step_name"),
        _choice("event_type", {"signup": "STARTED", "error": "FAILED"}, "SUCCESS").alias("status"),
        F.when(~started, F.floor(F.col("value") * 100).cast("bigint")).alias("rows_processed"),
        F.when(~started, F.floor("value").cast("bigint")).alias("duration_secs"),
        F.when(failed, F.col("props")).alias("error_message"),
        F.col("ts").alias("logged_at"),
    )


STEP_LOG_SQL = """
    SELECT event_id AS seq, user_id AS run_id,
           CASE event_type WHEN 'signup' THEN 'ASSESSMENT' WHEN 'view' THEN 'TRANSLATION'
                WHEN 'click' THEN 'LOAD' ELSE 'VALIDATION' END AS phase,
           'STEP_' || upper(event_type) AS step_name,
           CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'error' THEN 'FAILED'
                ELSE 'SUCCESS' END AS status,
           CASE WHEN event_type <> 'signup' THEN CAST(floor(value * 100) AS BIGINT) END AS rows_processed,
           CASE WHEN event_type <> 'signup' THEN CAST(floor(value) AS BIGINT) END AS duration_secs,
           CASE WHEN event_type = 'error' THEN props END AS error_message,
           ts AS logged_at
    FROM events"""


def translations(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("role") == "user", F.lit("CONV_")).otherwise(F.lit("conv_"))
    return read_table(spark, folder, "conversations").select(
        F.col("turn").alias("translation_id"),
        F.concat(name, F.col("conv_id").cast("string")).alias("source_table"),
        F.col("text").alias("original_ddl"),
        F.upper("role").alias("translated_ddl"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, turn, 0, 0)").alias(
            "translated_at"
        ),
    )


TRANSLATIONS_SQL = """
    SELECT turn AS translation_id,
           CASE WHEN role = 'user' THEN 'CONV_' ELSE 'conv_' END || CAST(conv_id AS VARCHAR) AS source_table,
           text AS original_ddl, upper(role) AS translated_ddl,
           TIMESTAMP '2024-01-01 00:00:00' + turn * INTERVAL 1 HOUR AS translated_at
    FROM conversations"""


@dataclass(frozen=True)
class Statement:
    """A statement template of the query log, and what is true of its statements."""

    text: str
    category: str
    reads: tuple[str, ...] = ()
    writes: tuple[str, ...] = ()
    joins: int = 0
    tier: str = "GREEN"
    replacements: int = 0


_TABLE, _BASKET = "store.{table}", "mart.basket_{user}"

# The query log's statements: two for each event type, for events of even and of odd ids. The second
# ones hold words and names where they mean nothing, or where a plain search would miss them.
STATEMENTS = {
    "signup": (
        Statement(
            "/* nightly */ WITH fresh AS (SELECT o_orderkey FROM store.{table} WHERE o_custkey = {user})\n"
            "INSERT INTO mart.seen SELECT o_orderkey FROM fresh",
            "ETL",
            (_TABLE,),
            ("mart.seen",),
        ),
        Statement(
            "SELECT * FROM store.{table} -- from old_{table}, gone\nWHERE note = 'moved into archive' AND o_custkey = {user}",
            "AD_HOC",
            (_TABLE,),
        ),
    ),
    "purchase": (
        Statement(
            "SELECT l_partkey, l_quantity INTO mart.basket_{user} FROM store.lineitem JOIN store.{table} ON l_orderkey = o_orderkey",
            "ETL",
            ("store.lineitem", _TABLE),
            (_BASKET,),
            1,
        ),
        Statement(
            "SELECT sum(l_quantity) FROM store.lineitem l, store.{table} AS o, (SELECT 1 AS one) AS x\n"
            "WHERE l_orderkey = o_orderkey AND extract(year FROM l_shipdate) > {user}",
            "REPORTING",
            ("store.lineitem", _TABLE),
            (),
            2,
        ),
    ),
    "view": (
        Statement(
            "-- dearest first\n(SELECT c_mktsegment, avg(o_totalprice) AS price FROM store.customer "
            "JOIN store.{table} ON o_custkey = c_custkey WHERE c_custkey > {user} GROUP BY c_mktsegment ORDER BY price DESC)",
            "REPORTING",
            ("store.customer", _TABLE),
            (),
            1,
        ),
        Statement(
            'SELECT "group by" FROM "Store" . "{table}" WHERE "copy" = \'distkey; sortkey\' /* getdate() */ AND o_custkey = {user}',
            "AD_HOC",
            (_TABLE,),
        ),
    ),
    "click": (
        Statement(
            "SELECT c_name, ISNULL(c_mktsegment, 'none') FROM store.{table} WHERE c_custkey = {user} AND opened < GETDATE()",
            "AD_HOC",
            (_TABLE,),
            tier="YELLOW",
            replacements=2,
        ),
        Statement(
            "WITH a AS (SELECT * FROM store.{table}), b (k, n) AS (SELECT o_custkey, count(*) FROM a, store.nation GROUP BY o_custkey)\n"
            "DELETE FROM mart.seen USING b WHERE k = {user} OR ISNULL(n, 0) = 0",
            "ETL",
            (_TABLE, "store.nation"),
            ("mart.seen",),
            1,
            "YELLOW",
            1,
        ),
    ),
    "error": (
        Statement("-- after the load\nVACUUM store.{table}", "MAINTENANCE", (), (_TABLE,), tier="RED"),
        Statement(
            "UPDATE mart.seen SET note = 'it''s from b, c' FROM store.{table} t, store.customer\n"
            "WHERE note IN (SELECT n_name FROM listed({user}), store.nation) -- vacuum",
            "ETL",
            (_TABLE, "store.customer", "store.nation"),
            ("mart.seen",),
            2,
        ),
    ),
}


def query_log(spark: SparkSession, folder: str) -> DataFrame:
    table = (
        F.when(F.col("value") < 1.5, F.lit("orders"))
        .when(F.col("value") < 6, F.lit("returns"))
        .otherwise(F.lit("archive"))
    )
    text = F
    for kind, statements in STATEMENTS.items():
        for odd, statement in enumerate(statements):
            own = (F.col("event_type") == kind) & (F.pmod("event_id", F.lit(2)) == odd)
            text = text.when(own, fill(statement.text, table=table, user=F.col("user_id")))
    events = read_table(spark, folder, "events")
    return dealt(events.select("event_id", "event_type", "user_id", "value")).select(
        F.col("event_id").alias("query_id"), text.alias("query_text")
    )


def _list_sql(names: tuple[str, ...]) -> str:
    return "[" + ", ".join(fill_sql(name, table="tbl", user="user_id") for name in names) + "]::VARCHAR[]"


def _query_log_sql() -> str:
    """The log, with what is true of each statement as further columns."""
    table = "CASE WHEN value < 1.5 THEN 'orders' WHEN value < 6 THEN 'returns' ELSE 'archive' END"
    known = [(f"event_type = '{kind}' AND event_id % 2 = {odd}", statement) for kind, statements in STATEMENTS.items() for odd, statement in enumerate(statements)]
    columns = {
        "query_text": lambda s: fill_sql(s.text, table="tbl", user="user_id"),
        "query_category": lambda s: f"'{s.category}'",
        "reads": lambda s: _list_sql(s.reads),
        "writes": lambda s: _list_sql(s.writes),
        "joins": lambda s: str(s.joins),
        "complexity_level": lambda s: f"'{s.tier}'",
        "replacements": lambda s: str(s.replacements),
    }
    cases = [f"CASE {' '.join(f'WHEN {when} THEN {value(statement)}' for when, statement in known)} END AS {name}" for name, value in columns.items()]
    return f"SELECT event_id AS query_id, event_type, {', '.join(cases)} FROM (SELECT *, {table} AS tbl FROM events)"


QUERY_LOG_SQL = _query_log_sql()

# Text of a table definition built from one part row (fixed value).
DEFINITION = """CREATE  TABLE src.part_{key} (
    partkey INTEGER NOT NULL ENCODE az64,
    name VARCHAR({size}) ENCODE lzo,
    seen TIMESTAMP ENCODE az64,
    checked TIMESTAMPTZ DEFAULT GETDATE(),
    timestamp_of_{kind} TIMESTAMP,
    payload SUPER,
    visitors HLLSKETCH,
    flag BOOL DEFAULT ISNULL(x, 0),
)
DISTSTYLE KEY
DISTKEY (partkey)
DISTKEY(name)
INTERLEAVED SORTKEY(partkey, seen);

-- {name}: STOP SUPERB, éSUPER, cost $1 \\d

"""


def definitions(spark: SparkSession, folder: str) -> DataFrame:
    text = fill(
        DEFINITION,
        key=F.col("p_partkey"),
        size=F.col("p_size"),
        kind=F.lower("p_type"),
        name=F.col("p_name"),
    )
    part = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_size")
    return dealt(part).select("p_partkey", text.alias("original_ddl"))


DEFINITIONS_SQL = (
    "SELECT p_partkey, "
    + fill_sql(DEFINITION, key="p_partkey", size="p_size", kind="lower(p_type)", name="p_name")
    + " AS original_ddl FROM part"
)
