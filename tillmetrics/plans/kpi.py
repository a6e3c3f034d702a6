"""Executive key figures in one row."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import cents, ratio, rounded_amount, rounded_percent, to_amount
from tillmetrics.functions.dates import days_before
from tillmetrics.operators.rollups import CANCELLED, count_key
from tillmetrics.plans import REFERENCE, Tables, is_corrected

REVENUE_DAYS = 30
ACTIVE_DAYS = 90


def _cents_where(condition: Column, amount: str) -> Column:
    return F.sum(F.when(condition, cents(amount)).otherwise(0))


def kpi_dashboard(
    tables: Tables, as_of: dt.date, mode: str = REFERENCE, unique_keys: bool = True
) -> DataFrame:
    """Revenue, orders, customers, products and payments as of a day.

    The customary figures come from pairing every order with every customer,
    product and payment: sums grow by the row counts of the other three tables,
    and all customers count as active as soon as any order is recent. Those
    factors are applied here to one aggregate per table, so nothing is paired.
    The corrected figures leave the factors out and count the customers who
    ordered recently.
    """
    corrected = is_corrected(mode)
    orders = tables["orders"].filter(F.col("order_id").isNotNull())
    not_cancelled = F.col("status") != CANCELLED
    recent = F.col("order_date") >= days_before(as_of, REVENUE_DAYS)
    active = F.col("order_date") >= days_before(as_of, ACTIVE_DAYS)
    order_side = [
        F.count("*").alias("n_orders"),
        _cents_where(not_cancelled, "total_amount").alias("revenue"),
        _cents_where(not_cancelled & recent, "total_amount").alias("recent_revenue"),
        count_key("order_id", unique_keys).alias("total_orders"),
        count_key(F.when(not_cancelled, F.col("order_id")), unique_keys).alias(
            "successful_orders"
        ),
    ]
    if corrected:
        buyers = F.count_distinct(F.when(active, F.col("customer_id")))
        order_side.append(buyers.alias("recent_customers"))
    else:
        order_side.append(F.count_if(active).alias("recent_orders"))
    sides = [
        orders.agg(*order_side),
        tables["customers"].agg(
            F.count("*").alias("n_customers"),
            count_key("customer_id", unique_keys).alias("total_customers"),
        ),
        tables["products"].agg(
            F.count("*").alias("n_products"),
            count_key("product_id", unique_keys).alias("total_products"),
            count_key(
                F.when(F.col("stock_quantity") > 0, F.col("product_id")), unique_keys
            ).alias("in_stock_products"),
        ),
        tables["payments"].agg(
            F.count("*").alias("n_payments"),
            _cents_where(F.col("payment_status") == "completed", "amount").alias("completed"),
            _cents_where(F.col("payment_status") == "failed", "amount").alias("failed"),
        ),
    ]
    # Four one-row frames side by side: stacked, then the only value of each column.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    one_row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return _own_figures(one_row) if corrected else _paired_figures(one_row)


def _own_figures(row: DataFrame) -> DataFrame:
    return row.select(
        to_amount("revenue").alias("total_revenue"),
        to_amount("recent_revenue").alias("last_30d_revenue"),
        "total_orders",
        "successful_orders",
        "total_customers",
        F.col("recent_customers").alias("active_customers"),
        "total_products",
        "in_stock_products",
        to_amount("completed").alias("successful_payments"),
        to_amount("failed").alias("failed_payments"),
        rounded_amount(F.col("revenue"), F.col("total_orders")).alias("avg_order_value"),
        rounded_amount(F.col("revenue"), F.col("total_customers")).alias("revenue_per_customer"),
        rounded_percent(F.col("recent_customers"), F.col("total_customers")).alias(
            "active_customer_rate"
        ),
        rounded_percent(F.col("failed"), F.col("completed") + F.col("failed")).alias(
            "payment_failure_rate"
        ),
    )


def _paired_figures(row: DataFrame) -> DataFrame:
    # With an empty table there are no pairs: sums are NULL and counts zero.
    pairs = F.least("n_orders", "n_customers", "n_products", "n_payments") > 0

    def times(sum_of_cents: str, *counts: str) -> Column:
        product = to_amount(sum_of_cents)
        for n in counts:
            product = product * F.col(n).cast("double")
        return F.when(pairs, product)

    def counted(column: Column) -> Column:
        return F.when(pairs, column).otherwise(0).cast("bigint")

    others_of_orders = ("n_customers", "n_products", "n_payments")
    others_of_payments = ("n_orders", "n_customers", "n_products")
    active = F.when(F.col("recent_orders") > 0, F.col("total_customers")).otherwise(0)
    revenue = times("revenue", *others_of_orders)
    return row.select(
        revenue.alias("total_revenue"),
        times("recent_revenue", *others_of_orders).alias("last_30d_revenue"),
        counted(F.col("total_orders")).alias("total_orders"),
        counted(F.col("successful_orders")).alias("successful_orders"),
        counted(F.col("total_customers")).alias("total_customers"),
        counted(active).alias("active_customers"),
        counted(F.col("total_products")).alias("total_products"),
        counted(F.col("in_stock_products")).alias("in_stock_products"),
        times("completed", *others_of_payments).alias("successful_payments"),
        times("failed", *others_of_payments).alias("failed_payments"),
        F.round(ratio(revenue, F.col("total_orders")), 2).alias("avg_order_value"),
        F.round(ratio(revenue, F.col("total_customers")), 2).alias("revenue_per_customer"),
        rounded_percent(active, F.when(pairs, F.col("total_customers"))).alias(
            "active_customer_rate"
        ),
        F.when(
            pairs, rounded_percent(F.col("failed"), F.col("completed") + F.col("failed"))
        ).alias("payment_failure_rate"),
    )
