"""Retention of customer cohorts, a cohort being the month of the first live order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import rounded_percent, sum_cents, to_amount
from tillmetrics.functions.dates import year_month
from tillmetrics.functions.labels import full_name
from tillmetrics.operators.rollups import count_key, live, parent
from tillmetrics.plans import Tables


def _activity(tables: Tables, unique_keys: bool) -> DataFrame:
    """Orders and spend per customer and month, with the customer's first month.

    The window runs over a customer's months, not orders: a group is as long as
    the calendar even for a customer who places a third of all orders.
    """
    monthly = (
        live(tables["orders"])
        .groupBy("customer_id", year_month("order_date").alias("order_month"))
        .agg(
            count_key("order_id", unique_keys).alias("monthly_orders"),
            sum_cents("total_amount").alias("spend_cents"),
        )
    )
    return _with_first_month(monthly)


def _with_first_month(monthly: DataFrame) -> DataFrame:
    per_customer = Window.partitionBy("customer_id")
    return monthly.withColumn("first_order_month", F.min("order_month").over(per_customer))


def customer_monthly_activity(tables: Tables, unique_keys: bool = True) -> DataFrame:
    return (
        _activity(tables, unique_keys)
        .join(parent(tables, "customers", unique_keys), "customer_id")
        .select(
            "customer_id",
            full_name().alias("customer_name"),
            "signup_date",
            "order_month",
            "monthly_orders",
            to_amount("spend_cents").alias("monthly_spend"),
            "first_order_month",
        )
    )


def cohort_activity(tables: Tables, unique_keys: bool = True) -> DataFrame:
    """Active customers and revenue per cohort and month of activity.

    Activity has one row per customer and month, so customers are counted by rows.
    """
    return _cohorts(_activity(tables, unique_keys), parent(tables, "customers", unique_keys))


def cohort_activity_of(customer_months: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from rows per customer and month, such as states keep."""
    monthly = customer_months.select(
        "customer_id", "order_month", F.col("revenue_cents").alias("spend_cents")
    )
    return _cohorts(_with_first_month(monthly), customers)


def _cohorts(activity: DataFrame, customers: DataFrame) -> DataFrame:
    known = activity.join(customers.select("customer_id"), "customer_id", "left_semi")
    return known.groupBy(
        F.col("first_order_month").alias("cohort_month"),
        F.col("order_month").alias("activity_month"),
    ).agg(
        F.count("customer_id").alias("active_customers"),
        to_amount(F.sum("spend_cents")).alias("cohort_revenue"),
    )


def cohort_retention(
    tables: Tables, min_cohort: str = "2023-01", unique_keys: bool = True
) -> DataFrame:
    """Share of a cohort's first-month customers active in each later month."""
    cohorts = cohort_activity(tables, unique_keys).filter(F.col("cohort_month") >= min_cohort)
    by_month = Window.partitionBy("cohort_month").orderBy("activity_month")
    started = F.first("active_customers").over(by_month)
    return cohorts.select(
        "cohort_month",
        "activity_month",
        "active_customers",
        "cohort_revenue",
        rounded_percent(F.col("active_customers"), started).alias("retention_rate_percent"),
    ).orderBy("cohort_month", "activity_month")
