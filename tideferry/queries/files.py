"""Delimited files and append-only tables, through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideferry.operators.history import keep_history
from tideferry.operators.load import load_dataset, load_into, open_loaded, rejected_lines
from tideferry.queries.stand_ins import STEP_LOG_SQL, step_log
from tideferry.sources.delimited import Dataset, Field, dataset_for
from tideferry.sources.shared import scratch_path
from tideferry.sources.tables import read_table

_CUSTOMER = (
    Field("c_custkey", "bigint", required=True),
    Field("c_name", "string", max_length=25),
    Field("c_nationkey", "int", required=True),
    Field("c_acctbal", "double"),
    Field("c_mktsegment", "string", max_length=10),
)
_LINEITEM = (
    Field("l_orderkey", "bigint", required=True),
    Field("l_partkey", "bigint", required=True),
    Field("l_suppkey", "bigint", required=True),
    Field("l_linenumber", "int", required=True),
    Field("l_quantity", "decimal(8,2)"),
    Field("l_extendedprice", "double"),
    Field("l_discount", "double"),
    Field("l_tax", "double"),
    Field("l_returnflag", "string", max_length=1),
    Field("l_linestatus", "string", max_length=1),
    Field("l_shipdate", "timestamp_ntz"),
)


def _load(spark: SparkSession, name: str, lines: DataFrame, fields, sep: str):
    """Write text lines to a new folder and load them back; returns (table, rejects path)."""
    root = scratch_path(spark, name)
    lines.write.text(f"{root}/text")
    datasets = {name: Dataset(name, f"{root}/text", fields, sep)}
    dataset = dataset_for(datasets, name.upper())
    result = load_dataset(spark, dataset, f"{root}/table", f"{root}/rejects")
    return open_loaded(spark, dataset, result.path), result.rejects_path


def _fields(rows: DataFrame, **changed) -> list:
    return [changed.get(c, F.col(c).cast("string")) for c in rows.columns]


def delimited_load_pipe(spark: SparkSession, folder: str) -> DataFrame:
    """Customers through a pipe file, padded and with null tokens in one column."""
    customer = read_table(spark, folder, "customer")
    segment = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" NULL "))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("  "))
        .otherwise(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")))
    )
    line = F.concat_ws("|", *_fields(customer, c_mktsegment=segment)).alias("value")
    return _load(spark, "customer", customer.select(line), _CUSTOMER, "|")[0]


def delimited_load_tab(spark: SparkSession, folder: str) -> DataFrame:
    """Line items through a tab file whose dates are written month first."""
    rows = read_table(spark, folder, "lineitem")
    shipped = F.date_format("l_shipdate", "M/d/yyyy H:mm:ss")
    line = F.concat_ws("\t", *_fields(rows, l_shipdate=shipped)).alias("value")
    loaded = _load(spark, "lineitem_tab", rows.select(line), _LINEITEM, "\t")[0]
    return loaded.withColumn("l_quantity", F.col("l_quantity").cast("double"))


def _spoiled(rows: DataFrame) -> DataFrame:
    """Line items as pipe lines; certain quantities are written wrongly."""
    quantity = F.col("l_quantity")
    text = F.when(quantity == 50, F.lit("many")).when(quantity == 49, F.lit("12345678.90"))
    text = text.otherwise(quantity.cast("string"))
    flag = F.when(quantity == 46, F.lit("RR")).otherwise(F.col("l_returnflag"))
    number = F.when(quantity == 45, F.lit(" null ")).otherwise(F.col("l_linenumber").cast("string"))
    line = F.concat_ws(
        "|", *_fields(rows, l_quantity=text, l_returnflag=flag, l_linenumber=number)
    )
    line = (
        F.when(quantity == 48, F.concat(line, F.lit("|extra")))
        .when(quantity == 47, F.substring_index(line, "|", 10))
        .otherwise(line)
    )
    return rows.select(line.alias("value"))


def _load_spoiled(spark: SparkSession, folder: str):
    rows = read_table(spark, folder, "lineitem")
    return _load(spark, "lineitem_pipe", _spoiled(rows), _LINEITEM, "|")


def delimited_skip_bad(spark: SparkSession, folder: str) -> DataFrame:
    return _load_spoiled(spark, folder)[0].withColumn(
        "l_quantity", F.col("l_quantity").cast("double")
    )


def delimited_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Every rejected line, told by its keys, with the reason."""
    path = _load_spoiled(spark, folder)[1]
    rejects = spark.read.schema("line STRING, source_file STRING, reason STRING").parquet(path)
    keys = ("l_orderkey", "l_partkey", "l_suppkey")
    return rejects.select(
        *[F.split_part("line", F.lit("|"), F.lit(i)).cast("bigint").alias(k) for i, k in enumerate(keys, 1)],
        F.size(F.split("line", "\\|", -1)).alias("fields"),
        "reason",
    )


def delimited_reject_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The numbers of rejected lines in files that are read in several splits.

    A line carries its own number as its first field, and its file's as the
    second, so the result can be told from the lines alone.
    """
    rows = read_table(spark, folder, "lineitem")
    root = scratch_path(spark, "numbered")
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    files = rows.repartitionByRange(3, *order).sortWithinPartitions(*order).withColumn("n", F.monotonically_increasing_id())
    number = (F.col("n") % F.lit(1 << 33) + 1).cast("string")
    bad = F.col("l_quantity") >= 45
    line = F.concat_ws("|", F.when(bad, F.concat(F.lit("#"), number)).otherwise(number), F.shiftright("n", 33).cast("string"), F.col("l_orderkey").cast("string"))
    files.select(line.alias("value")).write.text(f"{root}/text")
    fields = (Field("number", "bigint", required=True), Field("file", "int", required=True), Field("l_orderkey", "bigint", required=True))
    # Splits are 16 KB however long the files are, so a task reads as many of them as it takes to keep the tasks few.
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    reading = {
        "spark.sql.files.maxPartitionBytes": "16k",
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.maxPartitionNum": str(tasks),
    }
    load_into(spark, Dataset("numbered", f"{root}/text", fields, "|"), f"{root}/table", reading)
    rejects = rejected_lines(spark, f"{root}/table")
    said = F.split_part("line", F.lit("|"), F.lit(1))
    return rejects.select(
        F.split_part("line", F.lit("|"), F.lit(3)).cast("bigint").alias("l_orderkey"),
        "reason",
        (F.substring(said, 2, 20).cast("bigint") == F.col("line_number")).alias("right_number"),
        (F.regexp_extract("source_file", r"part-(\d+)", 1).cast("int") == F.split_part("line", F.lit("|"), F.lit(2)).cast("int")).alias("right_file"),
    )


def audit_log_append(spark: SparkSession, folder: str) -> DataFrame:
    """The log appended in two steps, then read back by status."""
    log, path = step_log(spark, folder), scratch_path(spark, "step_log")
    for status in ("status = 'STARTED'", "status <> 'STARTED'"):
        log.filter(status).write.mode("append").parquet(path)
    return (
        spark.read.schema(log.schema)
        .parquet(path)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("steps"), F.sum("rows_processed").alias("rows"))
    )


def history_reset_keep(spark: SparkSession, folder: str) -> DataFrame:
    """The log without its failed steps, as a new table."""
    path = scratch_path(spark, "history")
    step_log(spark, folder).write.parquet(f"{path}/old")
    kept = keep_history(spark, f"{path}/old", F.col("status") != "FAILED", f"{path}/new")
    return kept.select("run_id", "seq", "phase", "step_name", "status", "rows_processed", "logged_at")


QUERIES = {
    "delimited_load_pipe": delimited_load_pipe,
    "delimited_load_tab": delimited_load_tab,
    "delimited_skip_bad": delimited_skip_bad,
    "delimited_rejects": delimited_rejects,
    "delimited_reject_lines": delimited_reject_lines,
    "audit_log_append": audit_log_append,
    "history_reset_keep": history_reset_keep,
}

ORACLE = {
    "delimited_load_pipe": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal,
               CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS c_mktsegment
        FROM customer""",
    "delimited_load_tab": "SELECT * FROM lineitem",
    "delimited_skip_bad": "SELECT * FROM lineitem WHERE l_quantity < 45",
    "delimited_rejects": """
        SELECT l_orderkey, l_partkey, l_suppkey,
               CASE l_quantity WHEN 48 THEN 12 WHEN 47 THEN 10 ELSE 11 END AS fields,
               CASE l_quantity WHEN 50 THEN 'TYPE:l_quantity' WHEN 49 THEN 'TYPE:l_quantity'
                    WHEN 48 THEN 'ARITY' WHEN 47 THEN 'ARITY' WHEN 46 THEN 'LENGTH:l_returnflag'
                    ELSE 'REQUIRED:l_linenumber' END AS reason
        FROM lineitem WHERE l_quantity >= 45""",
    "delimited_reject_lines": """
        SELECT l_orderkey, 'TYPE:number' AS reason, true AS right_number, true AS right_file FROM lineitem WHERE l_quantity >= 45""",
    "audit_log_append": f"""
        SELECT status, count(*) AS steps, CAST(sum(rows_processed) AS BIGINT) AS rows
        FROM ({STEP_LOG_SQL}) GROUP BY status""",
    "history_reset_keep": f"""
        SELECT run_id, seq, phase, step_name, status, rows_processed, logged_at
        FROM ({STEP_LOG_SQL}) WHERE status <> 'FAILED'""",
}
