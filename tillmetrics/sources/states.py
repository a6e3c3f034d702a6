"""Aggregates of stored orders, kept per part, so that a report after an append reads new rows only.

A part's rows never change, so what is aggregated of it once stays right: a state. A report merges the
states of the parts that the table has now. After an append one state is missing, and is made
from the new part alone; after a replacement the old ones are not asked for any more. A state
counts from the moment its job has finished, which Spark marks by an empty file; one half
written is made anew.

States add up over parts because a key is in one part only, which loading makes sure of:

- ``customer_months``: per customer and month the orders that were not cancelled, their revenue
  and span. Customers' value and cohorts follow from it.
- ``buyer_bitmaps``: per month the customers who bought, as bitmaps of their ids in blocks of
  32768. Bitmaps of any months and parts unite, so distinct buyers are exact for every span.
- ``buyer_sketches``: the same as sketches of a few KB, for estimates within some percent.
- ``day_customers``: per day and customer the orders that were not cancelled and their revenue.

``day_payments`` has a state per part of the payments and part of the orders: what was paid, and what
failed, per day of the order. After an append of payments only these are read, and of the orders
those in the range of their order ids; after an append of orders the same the other way round.
With ``day_customers`` the corrected daily trends follow. (The customary ones count an order once for
each of its payments, which does not add up over parts.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import sum_cents
from tillmetrics.operators.rollups import live, orders_by_customer, payments_by_order
from tillmetrics.schemas import ORDERS, PAYMENTS
from tillmetrics.sources import parquet_files, snapshots
from tillmetrics.sources.snapshots import Part

MONTH = "order_month"
DAY = "order_day"


def _customer_months(orders: DataFrame) -> DataFrame:
    return orders_by_customer(live(orders), keys=("customer_id", MONTH))


def _buyer_bitmaps(orders: DataFrame) -> DataFrame:
    buyers = live(orders).filter("customer_id IS NOT NULL").select(
        MONTH,
        F.bitmap_bucket_number("customer_id").alias("bucket"),
        F.bitmap_bit_position("customer_id").alias("bit"),
    )
    return buyers.groupBy(MONTH, "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def _buyer_sketches(orders: DataFrame) -> DataFrame:
    return live(orders).groupBy(MONTH).agg(F.hll_sketch_agg("customer_id").alias("sketch"))


def _day_customers(orders: DataFrame) -> DataFrame:
    day = F.to_date("order_date").alias(DAY)
    found = live(orders).groupBy(day, "customer_id").agg(
        F.count("order_id").alias("orders"),
        sum_cents("total_amount").alias("revenue_cents"),
        F.count("total_amount").alias("priced_rows"),
    )
    return found.sortWithinPartitions(DAY)  # reports skip the days before those they need


def _day_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    days = live(orders).select("order_id", F.to_date("order_date").alias(DAY))
    return payments_by_order(payments).join(days, "order_id").groupBy(DAY).agg(
        F.sum("paid_cents").alias("paid_cents"), F.sum("failed_payments").alias("failed_payments")
    )


STATES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customer_months": _customer_months,
    "buyer_bitmaps": _buyer_bitmaps,
    "buyer_sketches": _buyer_sketches,
    "day_customers": _day_customers,
}


def _folder(root: str, name: str, part: Part) -> str:
    return f"{root}/{ORDERS.name}/{snapshots.beside(part, f'state_{name}')}"


def refresh(spark: SparkSession, root: str, name: str) -> list[Part]:
    """Make the states that the orders' parts lack; returns those parts."""
    made = []
    for part in parquet_files.version(spark, root, ORDERS).parts:
        folder = _folder(root, name, part)
        if not snapshots.exists(spark, f"{folder}/_SUCCESS"):
            rows = parquet_files.read_part(spark, root, ORDERS, part)
            STATES[name](rows).write.mode("overwrite").parquet(folder)
            made.append(part)
    return made


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The states of all parts of the orders as of now, those missing made first."""
    refresh(spark, root, name)
    parts = parquet_files.version(spark, root, ORDERS).parts
    if not parts:
        raise FileNotFoundError(f"{root}/{ORDERS.name} is not stored")
    nothing = parquet_files.read_part(spark, root, ORDERS, parts[0]).limit(0)
    schema = STATES[name](nothing).schema
    return spark.read.schema(schema).parquet(*[_folder(root, name, p) for p in parts])


def customer_months(spark: SparkSession, root: str) -> DataFrame:
    """One row per customer and month, whatever the number of parts."""
    return _summed(read(spark, root, "customer_months"), "customer_id", MONTH)


def customers_orders(spark: SparkSession, root: str) -> DataFrame:
    """One row per customer, as ``orders_by_customer`` gives for the live orders."""
    return _summed(read(spark, root, "customer_months"), "customer_id")


def _pair_folder(root: str, paid: Part, sold: Part) -> str:
    """A state of two parts lies beside the payments' part and is named after the orders' too."""
    name = sold.folder.rsplit("=", 1)[1]
    return f"{root}/{PAYMENTS.name}/{snapshots.beside(paid, f'state_day_payments_{name}')}"


def refresh_day_payments(spark: SparkSession, root: str) -> list[tuple[Part, Part]]:
    """Make the payments' states that are missing; returns their pairs of parts.

    Of either part the rows are read whose order ids lie in the other's range.
    """
    made = []
    sold_parts = parquet_files.version(spark, root, ORDERS).parts
    for paid in parquet_files.version(spark, root, PAYMENTS).parts:
        lacking = [
            (sold, folder)
            for sold in sold_parts
            if not snapshots.exists(spark, f"{(folder := _pair_folder(root, paid, sold))}/_SUCCESS")
        ]
        if not lacking:
            continue
        payments = parquet_files.read_part(spark, root, PAYMENTS, paid)
        low, high = payments.agg(F.min("order_id"), F.max("order_id")).first()
        for sold, folder in lacking:
            ids = sold.keys["order_id"]
            orders = parquet_files.read_part(spark, root, ORDERS, sold)
            near = _day_payments(
                payments.filter(F.col("order_id").between(ids.least, ids.largest)),
                orders.filter(F.col("order_id").between(F.lit(low), F.lit(high))),
            )
            near.coalesce(1).write.mode("overwrite").parquet(folder)  # a row a day
            made.append((paid, sold))
    return made


def daily_figures(spark: SparkSession, root: str, days: int | None = None) -> DataFrame:
    """``daily_metrics`` of the stored orders, corrected; of the newest ``days`` with orders, or all."""
    sold = read(spark, root, "day_customers")
    refresh_day_payments(spark, root)
    paid_parts = parquet_files.version(spark, root, PAYMENTS).parts
    if not paid_parts:
        raise FileNotFoundError(f"{root}/{PAYMENTS.name} is not stored")
    folders = [
        _pair_folder(root, paid, part)
        for paid in paid_parts
        for part in parquet_files.version(spark, root, ORDERS).parts
    ]
    paid = spark.read.schema(f"{DAY} date, paid_cents bigint, failed_payments bigint").parquet(*folders)
    if days is not None:
        newest = sold.select(DAY).dropna().distinct().orderBy(F.desc(DAY)).limit(days)
        needed = (F.col(DAY) >= newest.agg(F.min(DAY)).scalar()) | F.col(DAY).isNull()
        sold, paid = sold.filter(needed), paid.filter(needed)
    # A customer may have bought in orders of several parts.
    customers = sold.groupBy(DAY, "customer_id").agg(
        *[F.sum(c).alias(c) for c in ("orders", "revenue_cents", "priced_rows")]
    )
    daily = customers.groupBy(DAY).agg(
        F.sum("orders").alias("daily_orders"),
        F.count("customer_id").alias("daily_customers"),
        F.sum("revenue_cents").alias("revenue_cents"),
        F.nullif(F.sum("priced_rows"), F.lit(0)).alias("priced_rows"),
    )
    payments = paid.groupBy(F.col(DAY).alias("paid_day")).agg(
        F.sum("paid_cents").alias("paid_cents"), F.sum("failed_payments").alias("failed_payments")
    )
    return daily.join(payments, F.col(DAY).eqNullSafe(F.col("paid_day")), "left").select(
        *daily.columns, "paid_cents", F.coalesce("failed_payments", F.lit(0)).alias("failed_payments")
    )


def _summed(states: DataFrame, *keys: str) -> DataFrame:
    sums = ("total_orders", "order_rows", "priced_orders", "revenue_cents")
    return states.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )


def distinct_buyers(spark: SparkSession, root: str, chars: int = 7) -> DataFrame:
    """Customers with an order that was not cancelled, per month or, by 4 characters, year: exact."""
    span = F.substring(MONTH, 1, chars).alias("span")
    united = read(spark, root, "buyer_bitmaps").groupBy(span, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return united.groupBy("span").agg(F.sum(F.bitmap_count("bitmap")).alias("buyers"))


def estimated_buyers(spark: SparkSession, root: str, chars: int = 7) -> DataFrame:
    """``distinct_buyers`` within some percent, from sketches."""
    span = F.substring(MONTH, 1, chars).alias("span")
    united = read(spark, root, "buyer_sketches").groupBy(span).agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select("span", F.hll_sketch_estimate("sketch").alias("buyers"))
