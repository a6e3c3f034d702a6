"""Joins of the tables, row by row.

No side is marked for broadcast: Spark broadcasts a side whose size it knows or
measures to be small, and otherwise sorts and merges, splitting a key that holds
too many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.dates import days_between
from tillmetrics.operators.rollups import live
from tillmetrics.plans import Tables


def orders_of_customers(tables: Tables) -> DataFrame:
    customers = tables["customers"].select("customer_id", "customer_tier")
    return (
        tables["orders"]
        .join(customers, "customer_id")
        .select("order_id", "customer_id", "customer_tier", "status")
    )


def order_lines(tables: Tables) -> DataFrame:
    """Lines with their order, product and customer; the smaller tables join each other first."""
    orders = tables["orders"].join(
        tables["customers"].select("customer_id", "customer_tier"), "customer_id"
    )
    categories = tables["products"].select("product_id", "category")
    items = tables["order_items"].join(categories, "product_id")
    return items.join(orders, "order_id").select(
        "order_id",
        "order_item_id",
        "category",
        "customer_tier",
        "status",
        "quantity",
        F.col("subtotal").cast("double").alias("subtotal"),
    )


HOT_ROWS = 1_000_000  # fewer rows of a key are no burden to one task
_TRACKED = 1 << 16  # keys that a sketch follows; it misses none with a ten-thousandth of the rows
_LISTED = 1000  # keys that a sketch returns


def frequent_keys(df: DataFrame, key: str, least_rows: int) -> dict[object, int]:
    """Keys with about ``least_rows`` rows or more, and how many, from one pass over the key.

    The sketch (of the Misra-Gries kind) keeps a bounded number of counters per task.
    A key with a ten-thousandth of all rows is always among them.
    """
    top = F.expr(f"approx_top_k(`{key}`, {_LISTED}, {_TRACKED})").alias("top")
    found = df.filter(F.col(key).isNotNull()).agg(top).first()["top"]
    return {r["item"]: r["count"] for r in found or [] if r["count"] >= least_rows}


def left_join_split(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left join for a right side whose rows may pile up on one key.

    Spark splits a hot key of either side of an inner join, but not of the optional side of an
    outer one. So hot keys are found first, and the right side's rows of just these are dealt to
    salts, as many as a key has shares of ``hot_rows``; the left side's rows of these keys
    meet every salt. Each has a partner under some salt, hence those without one are no
    result. Both sides are read once. Apart from the key they must not share column names.
    """
    shares = {k: -(-n // hot_rows) for k, n in frequent_keys(right, key, hot_rows).items()}
    shares = {k: n for k, n in shares.items() if n > 1}
    if not shares:
        return left.join(right, key, "left")
    pairs = [F.lit(x).cast(t) for k, n in shares.items() for x, t in ((k, right.schema[key].dataType), (n, "int"))]
    salts = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(key)), F.lit(1))
    dealt = right.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), salts).cast("int"))
    dealt = dealt.withColumn("_met", F.lit(True))
    spread = left.withColumn("_salts", salts).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    joined = spread.join(dealt, [key, "_salt"], "left")
    return joined.filter((F.col("_salts") == 1) | F.col("_met")).drop("_salt", "_salts", "_met")


def orders_with_payments(tables: Tables) -> DataFrame:
    orders = tables["orders"].select("order_id", "status")
    payments = tables["payments"].select("order_id", "payment_id", "payment_status")
    return left_join_split(orders, payments, "order_id")


def customers_with_live_orders(tables: Tables) -> DataFrame:
    """All customers; a condition on the outer side filters that side before the join."""
    orders = live(tables["orders"]).select("customer_id", "order_id")
    return left_join_split(tables["customers"].select("customer_id"), orders, "customer_id")


def orders_without_items(tables: Tables) -> DataFrame:
    """Lines are reduced to their orders first: a large order arrives as one row per task."""
    with_items = tables["order_items"].select("order_id").distinct()
    return (
        tables["orders"]
        .join(with_items, "order_id", "left_anti")
        .select("order_id", "status", F.col("total_amount").cast("double").alias("total_amount"))
    )


def payments_beside_orders(tables: Tables) -> DataFrame:
    orders = tables["orders"].select(
        "order_id", F.col("total_amount").alias("order_amount"), "order_date"
    )
    return (
        tables["payments"]
        .join(orders, "order_id")
        .select(
            "payment_id",
            "order_id",
            F.col("amount").cast("double").alias("amount"),
            F.col("order_amount").cast("double").alias("order_amount"),
            days_between(F.col("order_date"), F.col("payment_date")).alias("days_to_payment"),
        )
    )
