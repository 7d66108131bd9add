"""Rewriting, classification and assessment of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideferry.functions.frames import dealt, union_all
from tideferry.model import TRANSLATION_RULES
from tideferry.operators import classify, profile, rewrite, sketches
from tideferry.operators.rewrite import CLAUSE_STRIP, DEFAULT_RULES, FUNCTION_MAP, TYPE_MAP, Rule
from tideferry.operators.statements import query_tables
from tideferry.plans import reports
from tideferry.queries.stand_ins import (
    ALL,
    DEFINITIONS_SQL,
    QUERY_LOG_SQL,
    definitions,
    fill,
    fill_sql,
    query_log,
)
from tideferry.sources.shared import scratch_path
from tideferry.sources.tables import read_table, read_tables

# Rules aimed at words of the documents, one kind after the other.
DOCUMENT_RULES = (
    Rule(TYPE_MAP, "the", "the$1", rule_id="1"),
    Rule(TYPE_MAP, "and", r"an\d", rule_id="2"),
    Rule(TYPE_MAP, "der|die", "d_", rule_id="3"),
    Rule(CLAUSE_STRIP, r"of\s+\w+", rule_id="4"),
    Rule(FUNCTION_MAP, "is ", "was ", rule_id="5"),
    Rule(FUNCTION_MAP, r"(la)\s+(le)", "$2 $1", is_regex=True, rule_id="6"),
)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return dealt(read_table(spark, folder, "documents").select("doc_id", "text"))


def rewrite_type_map(spark: SparkSession, folder: str) -> DataFrame:
    text = rewrite.apply_kind(F.col("text"), DOCUMENT_RULES, TYPE_MAP)
    return _documents(spark, folder).select("doc_id", text.alias("rewritten"))


def rewrite_clause_strip(spark: SparkSession, folder: str) -> DataFrame:
    text = rewrite.apply_kind(F.col("text"), DOCUMENT_RULES, CLAUSE_STRIP)
    return _documents(spark, folder).select("doc_id", text.alias("rewritten"))


def rewrite_function_map(spark: SparkSession, folder: str) -> DataFrame:
    text = rewrite.apply_kind(F.col("text"), DOCUMENT_RULES, FUNCTION_MAP)
    return _documents(spark, folder).select("doc_id", text.alias("rewritten"))


# A rule table: configuration rows with a Java letter class, and a word that must stay whole.
_RULE_ROWS = (
    ("1", TYPE_MAP, "the", "der", False),
    ("2", FUNCTION_MAP, r"(\p{L}+)\.(\s)", "$1;$2", True),
    ("3", FUNCTION_MAP, r"(?<![A-Za-z0-9_])on ", "off ", True),
    ("4", CLAUSE_STRIP, r"of\s+\w+", "", False),
)


def rewrite_from_rule_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = [{"config_id": i, "config_type": kind, "source_value": old, "target_value": new, "is_regex": regex, "is_active": True, "priority": 1} for i, kind, old, new, regex in _RULE_ROWS]
    table = spark.createDataFrame([tuple(row.get(name) for name in TRANSLATION_RULES.schema.names) for row in rows], TRANSLATION_RULES.schema)
    text = rewrite.apply_rules(F.col("text"), rewrite.rules_from(table))
    return _documents(spark, folder).select("doc_id", text.alias("rewritten"))


def _many_rules() -> list[tuple[str, str]]:
    """150 literal rules, each over what the one before left."""
    return [(f"th{chr(97 + i % 26)}", f"t{i}h") for i in range(150)]


def rewrite_many_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = [Rule(FUNCTION_MAP, old, new, rule_id=f"{i:03}") for i, (old, new) in enumerate(_many_rules())]
    return _documents(spark, folder).select("doc_id", rewrite.apply_rules(F.col("text"), rules).alias("rewritten"))


def rewrite_documents(spark: SparkSession, folder: str) -> DataFrame:
    return rewrite.rewrite(_documents(spark, folder), "text", DOCUMENT_RULES).select(
        "doc_id", "rewritten"
    )


def rewrite_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    return definitions(spark, folder).select(
        "p_partkey", rewrite.clean_up(F.col("original_ddl"), "src").alias("rewritten")
    )


def rewrite_full(spark: SparkSession, folder: str) -> DataFrame:
    return rewrite.rewrite(definitions(spark, folder), "original_ddl", DEFAULT_RULES, "src")


_QUALIFIED = "-- note\ncreate or  replace table part_{key} (id INT);\nCREATE OR REPLACE TABLE second (id INT);"
_ALREADY = "CREATE OR REPLACE TABLE store.TARGET.part_{key} (id INT);"


def rewrite_qualify(spark: SparkSession, folder: str) -> DataFrame:
    part = dealt(read_table(spark, folder, "part").select("p_partkey", "p_size"))
    key = F.col("p_partkey")
    text = F.when(F.col("p_size") < 25, fill(_QUALIFIED, key=key)).otherwise(fill(_ALREADY, key=key))
    name = F.concat(F.lit("part$"), key.cast("string"))
    return part.select(
        "p_partkey", rewrite.qualify(text, "store.TARGET", name).alias("rewritten")
    )


def rule_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    config = read_table(spark, folder, "events")
    return rewrite.deduplicated(config, ["event_type", "user_id"], "event_id").select(
        "event_id", "event_type", "user_id", "props"
    )


def definition_preview(spark: SparkSession, folder: str) -> DataFrame:
    texts = read_table(spark, folder, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("source_table"),
        F.col("text").alias("original_ddl"),
        F.upper("lang").alias("translated_ddl"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, n_chars, 0, 0)").alias("translated_at"),
        F.col("doc_id").alias("translation_id"),
    )
    return reports.definition_preview(texts)


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    answer = (
        F.when(kind == "signup", F.lit("  etl. "))
        .when(kind == "view", F.lit("Reporting or maintenance"))
        .when(kind == "click", F.lit("this is AdHoc"))
        .when(kind == "purchase", F.lit("Maintenance!\n"))
        .otherwise(F.concat(F.lit("not sure about "), F.col("user_id").cast("string")))
    )
    return read_table(spark, folder, "events").select("event_id", answer.alias("answer"))


_CLASSIFIED_AT = "2024-02-01 12:00:00"


def classified(spark: SparkSession, folder: str) -> DataFrame:
    return classify.classify(query_log(spark, folder))


# Tables whose columns are sketched, and the column that deals their rows to two loads.
_SKETCHED = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id"}


def inventory_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct values by the merged sketches of two loads, held against exact counts."""
    tables = read_tables(spark, folder, _SKETCHED)
    path = scratch_path(spark, "sketches")
    for load in (0, 1):
        part = {name: rows.filter(F.col(_SKETCHED[name]) % 2 == load) for name, rows in tables.items()}
        sketches.column_sketches(part, f"load {load}").write.mode("append").parquet(path)
    estimated = sketches.distinct_inventory(spark.read.parquet(path))
    exact = union_all(
        [
            rows.agg(*[F.count_distinct(c).alias(c) for c in rows.columns])
            .unpivot([], rows.columns, "column_name", "distinct_values")
            .withColumn("table_name", F.lit(name.upper()))
            for name, rows in tables.items()
        ]
    )
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_values"))
    return estimated.join(exact, ["table_name", "column_name"]).select(
        "table_name", "column_name", "row_count", "null_count", "distinct_values", (off <= 3 * sketches.ERROR * F.col("distinct_values")).alias("within_error")
    )


QUERIES = {
    "inventory_distinct": inventory_distinct,
    "rewrite_type_map": rewrite_type_map,
    "rewrite_clause_strip": rewrite_clause_strip,
    "rewrite_function_map": rewrite_function_map,
    "rewrite_documents": rewrite_documents,
    "rewrite_from_rule_table": rewrite_from_rule_table,
    "rewrite_many_rules": rewrite_many_rules,
    "rewrite_cleanup": rewrite_cleanup,
    "rewrite_full": rewrite_full,
    "rewrite_qualify": rewrite_qualify,
    "rule_dedupe": rule_dedupe,
    "definition_preview": definition_preview,
    "query_preview": lambda spark, folder: reports.query_preview(
        classified(spark, folder).withColumn("classified_at", F.expr(f"timestamp_ntz'{_CLASSIFIED_AT}'")),
        also=["query_id"],
    ),
    "classify_workload": lambda spark, folder: classified(spark, folder).select(
        "query_id", "query_category", "confidence"
    ),
    "label_normalise": lambda spark, folder: classify.normalise_labels(
        _answers(spark, folder), "answer"
    ),
    "category_distribution": lambda spark, folder: reports.category_distribution(
        classified(spark, folder)
    ),
    "confidence_distribution": lambda spark, folder: reports.confidence_distribution(
        classify.normalise_labels(_answers(spark, folder), "answer")
    ),
    "query_profile": lambda spark, folder: profile.query_profile(query_log(spark, folder)),
    "query_tables": lambda spark, folder: query_tables(query_log(spark, folder)),
    "complexity_tier": lambda spark, folder: profile.complexity_tier(
        query_log(spark, folder)
    ).select("query_id", "replacements", "complexity_level"),
    "column_inventory": lambda spark, folder: profile.column_inventory(
        read_tables(spark, folder, ALL)
    ),
}

# -- the same in SQL ------------------------------------------------------

_SPACE = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replaced(text: str, steps) -> str:
    """Nested replacements: (pattern, target, flags), or (old, new) for literals."""
    for step in steps:
        if len(step) == 2:
            text = f"replace({text}, {_literal(step[0])}, {_literal(step[1])})"
        else:
            pattern, target, flags = step
            text = f"regexp_replace({text}, {_literal(pattern)}, {_literal(target)}, '{flags}')"
    return text


_DOCUMENT_TYPES = [
    (r"\bthe\b", "the$1", "gi"),
    (r"\band\b", r"an\\d", "gi"),
    (r"\b(?:der|die)\b", "d_", "gi"),
]
_DOCUMENT_CLAUSES = [(r"of\s+\w+", "", "gi")]
_DOCUMENT_FUNCTIONS = [("is ", "was "), (r"(la)\s+(le)", r"\2 \1", "gi")]


def _cleanup(prefix: str | None) -> list:
    return [
        (rf"ENCODE{_SPACE}+\w+", "", "gi"),
        (rf"DISTSTYLE{_SPACE}+(KEY|ALL|EVEN)", "", "gi"),
        (rf"DISTKEY{_SPACE}*\([^)]+\)", "", "gi"),
        (rf"SORTKEY{_SPACE}*\([^)]+\)", "", "gi"),
        *([(rf"{prefix}\.", "", "gi")] if prefix else []),
        (rf"CREATE{_SPACE}+TABLE", "CREATE OR REPLACE TABLE", "gi"),
        (rf",{_SPACE}*\n{_SPACE}*\)", "\n)", "g"),
        (rf"\n{_SPACE}*\n", "\n", "g"),
    ]


_DEFINITION_STEPS = [
    (r"\bTIMESTAMP\b", "TIMESTAMP_NTZ", "gi"),
    (r"\bTIMESTAMPTZ\b", "TIMESTAMP_TZ", "gi"),
    (r"\bSUPER\b", "VARIANT", "gi"),
    (r"\bHLLSKETCH\b", "VARCHAR", "gi"),
    (r"\bFLOAT4\b", "FLOAT4", "gi"),
    (r"\bFLOAT8\b", "FLOAT8", "gi"),
    (r"\bBOOL\b", "BOOLEAN", "gi"),
    (r"DISTKEY\([^)]+\)", "", "gi"),
    (r"(?:INTERLEAVED\s+)?SORTKEY\s*\([^)]*\)", "", "gi"),
    (r"DISTSTYLE\s+\w+", "", "gi"),
    (r"ENCODE\s+\w+", "", "gi"),
    ("GETDATE()", "CURRENT_TIMESTAMP()"),
    ("ISNULL(", "NVL("),
    (r"\bTOP ", "LIMIT ", "gi"),
]


def _documents_sql(steps) -> str:
    return f"SELECT doc_id, {_replaced('text', steps)} AS rewritten FROM documents"


_ANSWERS = """(SELECT event_id, CASE event_type WHEN 'signup' THEN '  etl. '
        WHEN 'view' THEN 'Reporting or maintenance' WHEN 'click' THEN 'this is AdHoc'
        WHEN 'purchase' THEN 'Maintenance!' || chr(10)
        ELSE 'not sure about ' || CAST(user_id AS VARCHAR) END AS answer,
        CASE event_type WHEN 'signup' THEN 'ETL' WHEN 'view' THEN 'REPORTING' WHEN 'click' THEN 'AD_HOC'
        WHEN 'purchase' THEN 'MAINTENANCE' ELSE 'UNKNOWN' END AS query_category,
        CASE WHEN event_type = 'error' THEN 'LOW' ELSE 'HIGH' END AS confidence FROM events)"""

# Declared columns of the driver tables, for the inventory.
_DECLARED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _inventory_sql() -> str:
    selects = []
    for table, declared in _DECLARED.items():
        for position, column in enumerate(declared.split(", "), 1):
            name, kind = column.split(" ")
            selects.append(
                f"SELECT '{table.upper()}' AS table_name, {position} AS position, '{name}' AS column_name, "
                f"'{kind}' AS data_type, {str(kind.startswith('array')).lower()} AS is_complex, "
                f"count(*) AS row_count, count(*) - count({name}) AS null_count FROM {table}"
            )
    return " UNION ALL ".join(selects)


def _distinct_sql() -> str:
    selects = []
    for table in _SKETCHED:
        for declared in _DECLARED[table].split(", "):
            name = declared.split(" ")[0]
            selects.append(
                f"SELECT '{table.upper()}' AS table_name, '{name}' AS column_name, count(*) AS row_count, count(*) - count({name}) AS null_count, "
                f"count(DISTINCT {name}) AS distinct_values, true AS within_error FROM {table}"
            )
    return " UNION ALL ".join(selects)


ORACLE = {
    "inventory_distinct": _distinct_sql(),
    "rewrite_type_map": _documents_sql(_DOCUMENT_TYPES),
    "rewrite_clause_strip": _documents_sql(_DOCUMENT_CLAUSES),
    "rewrite_function_map": _documents_sql(_DOCUMENT_FUNCTIONS),
    "rewrite_documents": _documents_sql(
        [*_DOCUMENT_TYPES, *_DOCUMENT_CLAUSES, *_DOCUMENT_FUNCTIONS, *_cleanup(None)]
    ),
    "rewrite_from_rule_table": _documents_sql(
        [(r"\bthe\b", "der", "gi"), (r"(\p{L}+)\.(\s)", r"\1;\2", "gi"), (r"\bon ", "off ", "gi"), (r"of\s+\w+", "", "gi")]
    ),
    "rewrite_many_rules": _documents_sql(_many_rules()),
    "rewrite_cleanup": f"""
        SELECT p_partkey, {_replaced('original_ddl', _cleanup('src'))} AS rewritten
        FROM ({DEFINITIONS_SQL})""",
    "rewrite_full": f"""
        SELECT p_partkey, original_ddl,
               {_replaced('original_ddl', [*_DEFINITION_STEPS, *_cleanup('src')])} AS rewritten
        FROM ({DEFINITIONS_SQL})""",
    "rewrite_qualify": f"""
        SELECT p_partkey, CASE WHEN p_size < 25 THEN {fill_sql(
            _QUALIFIED.replace('create or  replace table part_{key}',
                               'CREATE OR REPLACE TABLE store.TARGET.PART${key}'), key='p_partkey')}
               ELSE {fill_sql(_ALREADY, key='p_partkey')} END AS rewritten FROM part""",
    "rule_dedupe": """
        SELECT event_id, event_type, user_id, props FROM events
        WHERE event_id IN (SELECT min(event_id) FROM events GROUP BY event_type, user_id)""",
    "definition_preview": """
        SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS source_table, left(text, 120) AS original_preview,
               left(upper(lang), 120) AS translated_preview,
               TIMESTAMP '2024-01-01 00:00:00' + n_chars * INTERVAL 1 HOUR AS translated_at FROM documents""",
    "query_preview": f"""
        SELECT query_id, query_category, 'HIGH' AS confidence, left(query_text, 100) AS query_preview,
               TIMESTAMP '{_CLASSIFIED_AT}' AS classified_at
        FROM ({QUERY_LOG_SQL})""",
    "classify_workload": f"SELECT query_id, query_category, 'HIGH' AS confidence FROM ({QUERY_LOG_SQL})",
    "label_normalise": f"SELECT event_id, answer, query_category, confidence FROM {_ANSWERS}",
    "category_distribution": f"""
        SELECT query_category, count(*) AS query_count FROM ({QUERY_LOG_SQL}) GROUP BY query_category""",
    "confidence_distribution": f"SELECT confidence, count(*) AS n FROM {_ANSWERS} GROUP BY confidence",
    "query_profile": f"""
        SELECT table_name, count(*) AS queries, count(*) FILTER (WHERE joins > 0) AS queries_with_join,
               CAST(max(joins) AS INTEGER) AS most_joins
        FROM (SELECT joins, unnest(list_distinct(list_concat(reads, writes))) AS table_name FROM ({QUERY_LOG_SQL}))
        GROUP BY table_name""",
    "query_tables": f"""
        SELECT query_id, unnest(reads) AS table_name, 'READ' AS usage, joins FROM ({QUERY_LOG_SQL})
        UNION ALL SELECT query_id, unnest(writes), 'WRITE', joins FROM ({QUERY_LOG_SQL})""",
    "complexity_tier": f"SELECT query_id, replacements, complexity_level FROM ({QUERY_LOG_SQL})",
    "column_inventory": _inventory_sql(),
}
