"""Daily trends with weekly averages and growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import (
    cents,
    ratio,
    rounded_amount,
    rounded_percent,
    to_amount,
)
from tillmetrics.functions.dates import year_month
from tillmetrics.operators.rollups import count_key, live, payments_by_order
from tillmetrics.plans import REFERENCE, Tables, is_corrected

WEEK = 7


def daily_metrics(
    orders: DataFrame, payments: DataFrame, mode: str = REFERENCE, unique_keys: bool = True
) -> DataFrame:
    """Orders, customers, revenue and payments per day of the given live orders.

    Customarily an order's amount counts once for each of its payments; the
    corrected figures count it once. Payments come as one row per order, which
    gives both without joining payment rows.
    """
    paid = orders.join(payments_by_order(payments), "order_id", "left")
    times = F.lit(1) if is_corrected(mode) else F.coalesce("payment_count", F.lit(1))
    amount = F.col("total_amount")
    return paid.groupBy(F.to_date("order_date").alias("order_day")).agg(
        count_key("order_id", unique_keys).alias("daily_orders"),
        F.count_distinct("customer_id").alias("daily_customers"),
        F.sum(cents(amount) * times).alias("revenue_cents"),
        F.sum(F.when(amount.isNotNull(), times)).alias("priced_rows"),
        F.sum("paid_cents").alias("paid_cents"),
        F.coalesce(F.sum("failed_payments"), F.lit(0)).alias("failed_payments"),
    )


def _with_zero_days(daily: DataFrame) -> DataFrame:
    """Every calendar day between the first and the last one, with zeros where nothing sold.

    Each day fills the gap up to the next one, so the daily figures are computed once.
    """
    next_day = F.lead("order_day").over(Window.orderBy("order_day"))
    last_filled = F.coalesce(F.date_sub(next_day, 1), F.col("order_day"))
    filled = daily.withColumn("last_filled", last_filled).withColumn(
        "day", F.explode(F.sequence("order_day", "last_filled"))
    )
    own = F.col("day") == F.col("order_day")
    zeroed = ("daily_orders", "daily_customers", "revenue_cents", "failed_payments")
    return filled.select(
        F.col("day").alias("order_day"),
        *[F.when(own, F.col(c)).otherwise(0).alias(c) for c in zeroed],
        *[F.when(own, F.col(c)).alias(c) for c in ("priced_rows", "paid_cents")],
    )


def _rolling(daily: DataFrame) -> DataFrame:
    """Sums over seven rows and the value seven rows earlier.

    One row per day reaches this window, so its single partition is bounded by
    the calendar, not by the orders.
    """
    by_day = Window.orderBy("order_day")
    last_week = by_day.rowsBetween(1 - WEEK, Window.currentRow)
    return daily.select(
        "*",
        F.sum("revenue_cents").over(last_week).alias("week_cents"),
        F.count("revenue_cents").over(last_week).alias("week_days"),
        F.avg("daily_orders").over(last_week).alias("weekly_avg_orders"),
        F.lag("revenue_cents", WEEK).over(by_day).alias("previous_cents"),
    )


def daily_rolling(tables: Tables, mode: str = REFERENCE, unique_keys: bool = True) -> DataFrame:
    """All days with their seven-day averages.

    Customarily a week is seven days that have orders; the corrected week is
    seven calendar days, those without orders counting zero.
    """
    daily = daily_metrics(live(tables["orders"]), tables["payments"], mode, unique_keys)
    return _rolling(_with_zero_days(daily) if is_corrected(mode) else daily).select(
        "order_day",
        "daily_orders",
        "daily_customers",
        to_amount("revenue_cents").alias("daily_revenue"),
        ratio(to_amount("revenue_cents"), F.col("priced_rows")).alias("avg_order_value"),
        to_amount("paid_cents").alias("daily_payments"),
        "failed_payments",
        ratio(to_amount("week_cents"), F.col("week_days")).alias("weekly_avg_revenue"),
        "weekly_avg_orders",
        to_amount("previous_cents").alias("revenue_previous_week"),
    )


def _since(orders: DataFrame, day: Column) -> DataFrame:
    """Orders from ``day`` on, and those without a date."""
    out = orders.filter((F.col("order_date") >= day) | F.col("order_date").isNull())
    if "order_month" in orders.columns:  # stored by month: skip the folders before
        undated = F.col("order_month").isNull()
        out = out.filter((F.col("order_month") >= year_month(day)) | undated)
    return out


def daily_trends(
    tables: Tables, mode: str = REFERENCE, days: int = 30, unique_keys: bool = True
) -> DataFrame:
    """The newest days with weekly average, growth and payment failure rate.

    They depend on seven more days at most. The first of those is found from the
    order dates alone; only orders since then meet the payments.
    """
    orders = live(tables["orders"])
    order_days = orders.select(F.to_date("order_date").alias("order_day")).dropna()
    newest = order_days.distinct().orderBy(F.desc("order_day")).limit(days + WEEK)
    recent = _since(orders, newest.agg(F.min("order_day")).scalar())
    # Where order ids grow with time, this leaves out most payments before they are shuffled.
    first_id = recent.agg(F.min("order_id")).scalar()
    payments = tables["payments"].filter(F.col("order_id") >= first_id)
    return trends_of(daily_metrics(recent, payments, mode, unique_keys), mode, days)


def trends_of(daily: DataFrame, mode: str = REFERENCE, days: int = 30) -> DataFrame:
    """``daily_trends`` from ``daily_metrics`` of the days they depend on, or states of them."""
    if is_corrected(mode):
        daily = _with_zero_days(daily)
    revenue, previous = F.col("revenue_cents"), F.col("previous_cents")
    return (
        _rolling(daily)
        .orderBy(F.desc_nulls_last("order_day"))
        .limit(days)
        .select(
            "order_day",
            "daily_orders",
            "daily_customers",
            to_amount(revenue).alias("daily_revenue"),
            rounded_amount(F.col("week_cents"), F.col("week_days")).alias("weekly_avg_revenue"),
            rounded_amount(revenue, F.col("priced_rows")).alias("avg_order_value"),
            rounded_percent(revenue - previous, previous).alias("weekly_growth_percent"),
            rounded_percent(F.col("failed_payments"), F.col("daily_orders")).alias(
                "payment_failure_rate"
            ),
        )
    )


def order_seasonality(tables: Tables) -> DataFrame:
    """Orders and orders per day by month and weekday (Monday is 0)."""
    by_day = tables["orders"].groupBy(F.to_date("order_date").alias("day")).count()
    return (
        by_day.groupBy(F.month("day").alias("month"), F.weekday("day").alias("weekday"))
        .agg(
            F.count("*").alias("days"),
            F.sum("count").alias("order_count"),
            ratio(F.sum("count"), F.count("*")).alias("orders_per_day"),
        )
        .withColumns(
            {
                "is_weekend": F.col("weekday") >= 5,
                "is_holiday_season": F.col("month") >= 11,
            }
        )
    )
