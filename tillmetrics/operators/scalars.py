"""Row-wise expressions over whole tables, all evaluated in generated JVM code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions import labels
from tillmetrics.functions.amounts import (
    cents,
    clamp,
    ratio,
    rounded_percent,
    rounded_ratio,
    whole_division,
)
from tillmetrics.functions.dates import days_before, days_between, hours_after, year_month
from tillmetrics.plans import Tables
from tillmetrics.quality.reconcile import price_range, stock_range
from tillmetrics.schemas import ORDER_STATUSES


def customer_names(tables: Tables) -> DataFrame:
    return tables["customers"].select("customer_id", labels.full_name().alias("customer_name"))


def payment_delay(tables: Tables, since: dt.date) -> DataFrame:
    """Days with their fraction."""
    start = F.lit(since.isoformat()).cast("timestamp_ntz")
    days = days_between(start, F.col("payment_date"))
    return tables["payments"].select("payment_id", days.alias("days_since"))


def order_calendar(tables: Tables) -> DataFrame:
    """Day, month and weekday (Monday is 0) of each order."""
    moment = F.col("order_date")
    return tables["orders"].select(
        "order_id",
        F.to_date(moment).alias("order_day"),
        year_month(moment).alias("order_month"),
        F.weekday(moment).alias("weekday"),
        F.month(moment).alias("month"),
    )


def date_offsets(tables: Tables, as_of: dt.date) -> DataFrame:
    """A day before a fixed day, days and hours after an order."""
    return tables["orders"].select(
        "order_id",
        days_before(as_of, 30).alias("month_before"),
        F.date_add(F.to_date("order_date"), 7).alias("week_after"),
        hours_after(F.col("order_date"), 36).alias("hours_after"),
    )


def unit_prices(tables: Tables) -> DataFrame:
    """Division that gives NULL for zero, with and without rounding."""
    subtotal, quantity = F.col("subtotal"), F.col("quantity")
    discounted = quantity - 1  # zero for single units
    return tables["order_items"].select(
        "order_item_id",
        ratio(subtotal, discounted).alias("per_further_unit"),
        rounded_ratio(cents(subtotal), discounted, 1).alias("cents_per_further_unit"),
    )


def margins(tables: Tables) -> DataFrame:
    """Percentages and the labels they give."""
    price, cost = cents("price"), cents("cost_price")
    margin = ratio(price - cost, price)
    return tables["products"].select(
        "product_id",
        rounded_percent(price - cost, price).alias("margin_percent"),
        labels.margin_category(margin).alias("margin_category"),
    )


def risk_labels(tables: Tables) -> DataFrame:
    label = labels.risk_category(F.col("risk_score"))
    return tables["payments"].select("payment_id", label.alias("risk_category"))


def stock_per_price(tables: Tables) -> DataFrame:
    """Whole-number division truncates."""
    whole = whole_division(F.col("stock_quantity"), F.floor("price"))
    return tables["products"].select("product_id", (whole * 30).alias("stock_per_price"))


def status_for_age(tables: Tables, as_of: dt.date) -> DataFrame:
    """Orders per status and the status a week-by-week progression gives an order of that age.

    The progression steps back one status per week of age and stays in range.
    """
    age_weeks = whole_division(F.date_diff(F.lit(as_of), F.to_date("order_date")), F.lit(7))
    last = len(ORDER_STATUSES) - 1
    step = clamp(F.lit(last) - age_weeks, 0, last)
    names = F.array(*[F.lit(s) for s in ORDER_STATUSES])
    expected = F.element_at(names, (step + 1).cast("int"))
    return (
        tables["orders"]
        .groupBy("status", expected.alias("expected_status"))
        .agg(F.count("*").alias("order_count"))
    )


def text_parts(tables: Tables) -> DataFrame:
    """Leading characters, title case, a replaced part."""
    return tables["products"].select(
        "product_id",
        F.substring("product_name", 1, 16).alias("short_name"),
        F.initcap("product_name").alias("title"),
        F.replace("subcategory", F.lit("Brand#"), F.lit("")).alias("brand_number"),
    )


def ranges_by_category(tables: Tables) -> DataFrame:
    """Values from a fixed table by category, with a default."""
    least, below = stock_range()
    lowest, highest = price_range()
    return tables["products"].selectExpr(
        "product_id",
        f"{least} AS least_stock",
        f"{below} AS stock_below",
        f"CAST({lowest} AS double) AS lowest_price",
        f"CAST({highest} AS double) AS highest_price",
    )


def missing_scores(tables: Tables) -> DataFrame:
    """Scores that are NULL or not a number, per tier."""
    score = F.col("loyalty_score")
    return (
        tables["customers"]
        .groupBy("customer_tier")
        .agg(
            F.count_if(score.isNull() | F.isnan(score)).alias("missing"),
            F.count("*").alias("customer_count"),
        )
    )


def formatted_shares(tables: Tables) -> DataFrame:
    """Share of live orders per customer as text with one place, and the last order as ISO text."""
    uncancelled = F.count_if(F.col("status") != "cancelled")
    return (
        tables["orders"]
        .groupBy("customer_id")
        .agg(
            F.format_string("%.1f%%", rounded_percent(uncancelled, F.count("*"), 1)).alias(
                "live_share"
            ),
            F.date_format(F.max("order_date"), "yyyy-MM-dd'T'HH:mm:ss").alias("last_order"),
        )
    )
