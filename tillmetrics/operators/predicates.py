"""Filters and projections of single tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.dates import days_before, year_month
from tillmetrics.operators.rollups import live
from tillmetrics.plans import Tables


def live_orders(tables: Tables) -> DataFrame:
    return live(tables["orders"]).select("order_id", "status")


def orders_since_month(tables: Tables, month: str) -> DataFrame:
    """Months as text compare in calendar order."""
    dated = tables["orders"].select("order_id", year_month("order_date").alias("order_month"))
    return dated.filter(F.col("order_month") >= month)


def orders_of_last_days(tables: Tables, as_of: dt.date, days: int) -> DataFrame:
    recent = F.col("order_date") >= days_before(as_of, days)
    return tables["orders"].filter(recent).select("order_id", "customer_id", "order_date")


def identified_orders(tables: Tables) -> DataFrame:
    return tables["orders"].filter(F.col("order_id").isNotNull()).select("order_id")


def risky_payments(tables: Tables, threshold: float) -> DataFrame:
    risky = F.col("risk_score") > threshold
    return tables["payments"].filter(risky).select("payment_id", "risk_score")


def failed_payments(tables: Tables) -> DataFrame:
    failed = F.col("payment_status") == "failed"
    return tables["payments"].filter(failed).select("payment_id", "payment_method")


def active_customers(tables: Tables) -> DataFrame:
    return tables["customers"].filter("is_active").select("customer_id", "customer_tier")


def active_products(tables: Tables) -> DataFrame:
    return tables["products"].filter("is_active").select("product_id", "category")


def products_with_profit(tables: Tables) -> DataFrame:
    """All columns and computed ones next to them."""
    money = {c: F.col(c).cast("double") for c in ("price", "cost_price")}
    profit = (F.col("price") - F.col("cost_price")).cast("double")
    return tables["products"].select("*", profit.alias("unit_profit")).withColumns(money)


def items_at_catalogue_price(tables: Tables) -> DataFrame:
    """Each line with its product's catalogue price: a lookup by key is a join."""
    prices = tables["products"].select("product_id", F.col("price").cast("double").alias("price"))
    return (
        tables["order_items"]
        .join(prices, "product_id")
        .select("order_item_id", "product_id", "quantity", "price")
    )
