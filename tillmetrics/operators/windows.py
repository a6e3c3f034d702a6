"""Windows over frames that were aggregated first, so that no partition grows with the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import ratio, sum_cents, to_amount
from tillmetrics.functions.dates import year_month
from tillmetrics.operators.rollups import live
from tillmetrics.plans import Tables

WEEK = 7


def _revenue_by_day(tables: Tables) -> DataFrame:
    return (
        live(tables["orders"])
        .groupBy(F.to_date("order_date").alias("order_day"))
        .agg(F.count("*").alias("daily_orders"), sum_cents("total_amount").alias("cents"))
    )


def price_beside_category_max(tables: Tables) -> DataFrame:
    """Maximum over a partition, as an aggregate joined back: categories are few and large."""
    products = tables["products"].select("product_id", "category", "price")
    dearest = products.groupBy(F.col("category").alias("_category")).agg(
        F.max("price").cast("double").alias("category_max_price")
    )
    joined = products.join(dearest, F.col("category").eqNullSafe(F.col("_category")))
    return joined.select(
        "product_id", "category", F.col("price").cast("double").alias("price"), "category_max_price"
    )


def rolling_week(tables: Tables) -> DataFrame:
    """Means over a day and the six days with orders before it."""
    week = Window.orderBy("order_day").rowsBetween(1 - WEEK, Window.currentRow)
    return _revenue_by_day(tables).select(
        "order_day",
        ratio(to_amount(F.sum("cents").over(week)), F.count("cents").over(week)).alias(
            "mean_revenue"
        ),
        F.avg("daily_orders").over(week).alias("mean_orders"),
    )


def revenue_week_before(tables: Tables) -> DataFrame:
    by_day = Window.orderBy("order_day")
    return _revenue_by_day(tables).select(
        "order_day",
        to_amount("cents").alias("revenue"),
        to_amount(F.lag("cents", WEEK).over(by_day)).alias("previous_revenue"),
    )


def first_month_of_customers(tables: Tables) -> DataFrame:
    """A window over a grouped frame: a customer's partition is at most one row per month."""
    monthly = (
        live(tables["orders"])
        .groupBy("customer_id", year_month("order_date").alias("order_month"))
        .agg(F.count("*").alias("monthly_orders"))
    )
    per_customer = Window.partitionBy("customer_id")
    return monthly.withColumn("first_month", F.min("order_month").over(per_customer))


def orders_against_first_month(tables: Tables) -> DataFrame:
    """First value of an ordered partition: each status's months against its first month."""
    monthly = (
        tables["orders"]
        .groupBy("status", year_month("order_date").alias("order_month"))
        .agg(F.count("*").alias("monthly_orders"))
    )
    by_month = Window.partitionBy("status").orderBy("order_month")
    return monthly.withColumn("first_month_orders", F.first("monthly_orders").over(by_month))
