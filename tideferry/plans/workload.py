"""Eight analytic queries, the statement shapes of a sales reporting workload.

Money is summed as whole cents, so totals do not depend on the order of rows.
Facts are aggregated by their own key before they meet a dimension: the join
then has one row per key and no hot key to split.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideferry.functions.numeric import cents, exact_total


def _total(column: str) -> Column:
    return exact_total(cents(F.col(column)))


def daily_sales(lineitem: DataFrame) -> DataFrame:
    """Sum and count of sales per day."""
    return (
        lineitem.groupBy(F.to_date("l_shipdate").alias("ship_date"))
        .agg(
            _total("l_extendedprice").cast("double").alias("total_sales"),
            F.count(F.lit(1)).alias("num_transactions"),
        )
    )


def _orders_by_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), _total("o_totalprice").alias("price")
    )


def customer_summary(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """Order count per customer with its nation; customers without orders count 0."""
    counted = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("orders")
    )
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(counted, "c_custkey", "left")
        .select(
            "c_custkey", "c_name", "n_name", F.coalesce("orders", F.lit(0)).alias("total_orders")
        )
    )


def _customer_totals(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer with orders: its nation, order count and price sum."""
    return (
        _orders_by_customer(orders)
        .join(customer.select("c_custkey", "c_nationkey"), "c_custkey")
        .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    )


def revenue_by_nation(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        _customer_totals(customer, nation, orders)
        .groupBy("n_name")
        .agg(
            F.sum("orders").alias("num_orders"),
            F.sum("price").cast("double").alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "n_name")
    )


def monthly_revenue(orders: DataFrame, rate: float = 0.15) -> DataFrame:
    """Monthly price sum and a commission at a fixed rate of each price."""
    price, points = cents(F.col("o_totalprice")), F.lit(round(rate * 10_000)).cast("bigint")
    commission = F.floor((price * points + F.lit(5_000)) / F.lit(10_000)).cast("bigint")
    return (
        orders.groupBy(F.trunc("o_orderdate", "month").cast("timestamp_ntz").alias("month"))
        .agg(
            _total("o_totalprice").cast("double").alias("monthly_revenue"),
            exact_total(commission).cast("double").alias("monthly_commission"),
        )
        .orderBy("month")
    )


def customers_by_nation(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct ordering customers and price sum per nation.

    One row per customer reaches the last step, so counting rows there counts
    distinct customers.
    """
    return (
        _customer_totals(customer, nation, orders)
        .groupBy("n_name")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("price").cast("double").alias("total_price"),
        )
    )


def segment_sample(customer: DataFrame, segment: str, minimum: float, rows: int = 100) -> DataFrame:
    """First hundred customers of a segment above a balance."""
    return (
        customer.filter((F.col("c_mktsegment") == segment) & (F.col("c_acctbal") > minimum))
        .orderBy("c_custkey")
        .limit(rows)
    )


def events_after(events: DataFrame, user: int, moment: datetime) -> DataFrame:
    """One user's events after a moment."""
    return events.filter(
        (F.col("user_id") == user) & (F.col("ts") > F.lit(moment).cast("timestamp_ntz"))
    ).select("event_id", "event_type", "ts")


def top_sales(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    supplier: DataFrame,
    above: float,
    rows: int = 50,
) -> DataFrame:
    """The dearest sales above a price with everything known about them.

    Keys decide which sales count; names are fetched for the few rows that are left.
    """
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    bought = orders.join(customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    top = (
        lineitem.filter(F.col("l_extendedprice") > above)
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        .join(bought.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part.select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier.select("s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .orderBy(*order)
        .limit(rows)
        .drop("p_partkey", "s_suppkey")
    )
    # At most ``rows`` rows, so the sides they are joined with stay where they are.
    top = F.broadcast(top)
    return (
        customer.join(top, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            "c_name", "p_name", "s_name", "l_extendedprice", "o_orderdate",
        )
        .orderBy(*order)
        .limit(rows)
    )
