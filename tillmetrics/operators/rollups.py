"""One row per order, customer or product, aggregated before any join.

A key that owns a large share of all rows is reduced on the map side first, so
no join or window downstream ever meets its raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import sum_cents
from tillmetrics.schemas import TABLES

CANCELLED = "cancelled"


def live(orders: DataFrame) -> DataFrame:
    """Orders that were not cancelled; a NULL status is dropped too."""
    return orders.filter(F.col("status") != CANCELLED)


def count_key(column: Column | str, unique_keys: bool) -> Column:
    """Number of distinct values of a table's primary key on the table's own rows.

    With ``unique_keys`` (which loading a table ensures) no value repeats, so
    counting rows is enough and the exact distinct count's extra shuffle of
    every row is saved.
    """
    return F.count(column) if unique_keys else F.count_distinct(column)


def parent(tables: Mapping[str, DataFrame], name: str, unique_keys: bool) -> DataFrame:
    """A table that others refer to by its key.

    A key on two of its rows would join every child twice. Loading makes sure there is
    none; tables from elsewhere (``unique_keys=False``) are looked through, and refused.
    """
    df, key = tables[name], TABLES[name].primary_key
    if not unique_keys:
        repeated = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").first()
        if repeated:
            raise ValueError(f"{name}.{key} {repeated[key]} is on {repeated['count']} rows; it must be unique")
    return df


def orders_by_customer(
    orders: DataFrame, unique_keys: bool = True, keys: tuple[str, ...] = ("customer_id",)
) -> DataFrame:
    return orders.groupBy(*keys).agg(
        count_key("order_id", unique_keys).alias("total_orders"),
        F.count("*").alias("order_rows"),
        F.count("total_amount").alias("priced_orders"),
        sum_cents("total_amount").alias("revenue_cents"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def payments_by_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count("*").alias("payment_count"),
        sum_cents("amount").alias("paid_cents"),
        F.count_if(F.col("payment_status") == "failed").alias("failed_payments"),
    )


def sales_by_product(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_units_sold"),
        sum_cents("subtotal").alias("revenue_cents"),
        F.count_distinct("order_id").alias("unique_orders"),
    )


def live_sales_by_product(items: DataFrame, orders: DataFrame) -> DataFrame:
    """``sales_by_product`` of the lines of live orders.

    Lines are added up per product and order first. Orders then count by rows,
    which needs no order in one place: Spark may split a large order over tasks
    when it looks up which ones are live.
    """
    per_order = items.groupBy("product_id", "order_id").agg(
        F.sum("quantity").alias("units"), sum_cents("subtotal").alias("cents")
    )
    kept = per_order.join(live(orders).select("order_id"), "order_id", "left_semi")
    return kept.groupBy("product_id").agg(
        F.sum("units").alias("total_units_sold"),
        F.sum("cents").alias("revenue_cents"),
        F.count("order_id").alias("unique_orders"),
    )


def items_by_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("line_count"), sum_cents("subtotal").alias("items_cents")
    )
