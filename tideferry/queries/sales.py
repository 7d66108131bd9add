"""The analytic workload on the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tideferry.plans import workload
from tideferry.sources.tables import read_tables


def _with(function, *names, **arguments):
    """A query that reads the named tables and passes them on in that order."""
    return lambda spark, folder: function(
        *read_tables(spark, folder, names).values(), **arguments
    )


def _daily_sales(lineitem):
    return workload.daily_sales(lineitem).withColumn("ship_date", F.col("ship_date").cast("string"))


QUERIES = {
    "workload_q1": _with(_daily_sales, "lineitem"),
    "workload_q2": _with(workload.customer_summary, "customer", "nation", "orders"),
    "workload_q3": _with(workload.revenue_by_nation, "customer", "nation", "orders"),
    "workload_q4": _with(workload.monthly_revenue, "orders"),
    "workload_q5": _with(workload.customers_by_nation, "customer", "nation", "orders"),
    "workload_q6": _with(workload.segment_sample, "customer", segment="MACHINERY", minimum=1000.0),
    "workload_q7": _with(
        workload.events_after, "events", user=7, moment=datetime(2024, 1, 15)
    ),
    "workload_q10": _with(
        workload.top_sales, "lineitem", "orders", "customer", "part", "supplier", above=50000.0
    ),
}

_PRICE = "CAST(o_totalprice AS DECIMAL(12, 2))"

ORACLE = {
    "workload_q1": """
        SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2))) AS DOUBLE) AS total_sales,
               count(*) AS num_transactions
        FROM lineitem GROUP BY 1""",
    "workload_q2": """
        SELECT c_custkey, c_name, n_name, count(o_orderkey) AS total_orders
        FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
        GROUP BY c_custkey, c_name, n_name""",
    "workload_q3": f"""
        SELECT n_name, count(o_orderkey) AS num_orders, CAST(sum({_PRICE}) AS DOUBLE) AS revenue
        FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
        GROUP BY n_name ORDER BY revenue DESC""",
    "workload_q4": f"""
        SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month,
               CAST(sum({_PRICE}) AS DOUBLE) AS monthly_revenue,
               CAST(sum(round({_PRICE} * CAST(0.15 AS DECIMAL(4, 2)), 2)) AS DOUBLE) AS monthly_commission
        FROM orders GROUP BY 1 ORDER BY 1""",
    "workload_q5": f"""
        SELECT n_name, count(DISTINCT c_custkey) AS customers, CAST(sum({_PRICE}) AS DOUBLE) AS total_price
        FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
        GROUP BY n_name""",
    "workload_q6": """
        SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 1000.0
        ORDER BY c_custkey LIMIT 100""",
    "workload_q7": """
        SELECT event_id, event_type, ts FROM events
        WHERE user_id = 7 AND ts > TIMESTAMP '2024-01-15 00:00:00'""",
    "workload_q10": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_name, p_name, s_name,
               l_extendedprice, o_orderdate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        WHERE l_extendedprice > 50000
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50""",
}
