"""Aggregations of single tables and over joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import cents, ratio, rounded_amount, sum_cents, to_amount
from tillmetrics.functions.dates import days_before, days_between, year_month
from tillmetrics.functions.labels import RISKY_PAYMENT
from tillmetrics.operators.rollups import CANCELLED, live, orders_by_customer
from tillmetrics.plans import Tables
from tillmetrics.schemas import PAYMENT_STATUSES


def orders_per_status(tables: Tables) -> DataFrame:
    return tables["orders"].groupBy("status").agg(F.count("*").alias("order_count"))


def buyers_per_status(tables: Tables) -> DataFrame:
    """Exact distinct count: Spark first removes repeats per task, then by status and customer."""
    return (
        tables["orders"]
        .groupBy("status")
        .agg(F.count_distinct("customer_id").alias("customer_count"))
    )


def buyers_by_recency(tables: Tables, as_of: dt.date, days: int) -> DataFrame:
    """Customers who ordered recently, and customers with live orders, in one row."""
    recent = F.col("order_date") >= days_before(as_of, days)
    uncancelled = F.col("status") != CANCELLED
    # One row per customer first: two distinct counts would send every order twice.
    per_customer = (
        tables["orders"]
        .groupBy("customer_id")
        .agg(F.max(recent).alias("recent"), F.max(uncancelled).alias("uncancelled"))
    )
    return per_customer.filter(F.col("customer_id").isNotNull()).agg(
        F.count_if("recent").alias("recent_customers"),
        F.count_if("uncancelled").alias("live_customers"),
        F.count("*").alias("all_customers"),
    )


def amounts_per_method(tables: Tables) -> DataFrame:
    return (
        tables["payments"]
        .groupBy("payment_method")
        .agg(
            to_amount(sum_cents("amount")).alias("total_amount"),
            ratio(to_amount(sum_cents("amount")), F.count("amount")).alias("mean_amount"),
        )
    )


def cost_and_profit_per_category(tables: Tables) -> DataFrame:
    """Sums of products of columns: units times cost, units times unit profit."""
    per_product = tables["order_items"].groupBy("product_id").agg(F.sum("quantity").alias("units"))
    priced = per_product.join(tables["products"], "product_id")
    units, cost = F.col("units"), cents("cost_price")
    return priced.groupBy("category").agg(
        to_amount(F.sum(units * cost)).alias("total_cost"),
        to_amount(F.sum(units * (cents("price") - cost))).alias("total_profit"),
    )


def failures_per_method(tables: Tables) -> DataFrame:
    """Counts of rows that satisfy a condition."""
    return (
        tables["payments"]
        .groupBy("payment_method")
        .agg(
            F.count_if(F.col("payment_status") == "failed").alias("failed_payments"),
            F.count_if(F.col("risk_score") > RISKY_PAYMENT).alias("high_risk_payments"),
        )
    )


def amounts_by_outcome(tables: Tables) -> DataFrame:
    """One column per payment outcome."""
    pivoted = (
        tables["payments"]
        .groupBy("payment_method")
        .pivot("payment_status", list(PAYMENT_STATUSES))
        .agg(sum_cents("amount"))
    )
    return pivoted.select(
        "payment_method",
        *[to_amount(F.coalesce(s, F.lit(0))).alias(f"{s}_amount") for s in PAYMENT_STATUSES],
    )


def order_span_per_status(tables: Tables) -> DataFrame:
    first, last = F.min("order_date"), F.max("order_date")
    return (
        tables["orders"]
        .groupBy("status")
        .agg(
            first.alias("first_order"),
            last.alias("last_order"),
            days_between(first, last).alias("span_days"),
        )
    )


def order_totals(tables: Tables) -> DataFrame:
    """One row over the whole table."""
    return tables["orders"].agg(
        F.count("*").alias("order_count"),
        to_amount(sum_cents("total_amount")).alias("total_amount"),
    )


def orders_per_country_tier(tables: Tables) -> DataFrame:
    """Two keys, both of the parent table: orders are counted per customer before the join."""
    per_customer = orders_by_customer(tables["orders"]).select("customer_id", "order_rows")
    return (
        tables["customers"]
        .join(per_customer, "customer_id")
        .groupBy("country", "customer_tier")
        .agg(F.sum("order_rows").alias("order_count"))
    )


def orders_per_month(tables: Tables) -> DataFrame:
    """The key is an expression."""
    return (
        live(tables["orders"])
        .groupBy(year_month("order_date").alias("order_month"))
        .agg(
            F.count("*").alias("order_count"),
            to_amount(sum_cents("total_amount")).alias("revenue"),
        )
    )


def orders_per_customer(tables: Tables) -> DataFrame:
    """Columns that depend on the key are joined after aggregating, not grouped by."""
    per_customer = orders_by_customer(tables["orders"]).select("customer_id", "order_rows")
    return (
        tables["customers"]
        .join(per_customer, "customer_id")
        .select("customer_id", "customer_tier", "country", F.col("order_rows").alias("order_count"))
    )


def customers_per_order_count(tables: Tables) -> DataFrame:
    """Aggregate of an aggregate."""
    per_customer = orders_by_customer(live(tables["orders"]))
    return per_customer.groupBy("total_orders").agg(
        F.count("*").alias("customer_count"),
        to_amount(F.sum("revenue_cents")).alias("revenue"),
    )


def large_cities(tables: Tables, min_customers: int) -> DataFrame:
    """Groups kept by their aggregate."""
    return (
        tables["customers"]
        .groupBy("country", "city")
        .agg(F.count("customer_id").alias("customer_count"))
        .filter(F.col("customer_count") >= min_customers)
    )


def revenue_per_buyer(tables: Tables) -> DataFrame:
    """Arithmetic on aggregates, safe for empty groups."""
    per_customer = orders_by_customer(live(tables["orders"]))
    joined = tables["customers"].join(per_customer, "customer_id", "left")
    revenue, buyers = F.sum("revenue_cents"), F.count("revenue_cents")
    return joined.groupBy("customer_tier").agg(
        rounded_amount(revenue, buyers).alias("revenue_per_buyer"),
        (F.count("*") - buyers).alias("customers_without_orders"),
    )
