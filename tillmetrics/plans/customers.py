"""Reports about customers: lifetime value, geography, tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import ratio, rounded_amount, to_amount
from tillmetrics.functions.dates import days_between
from tillmetrics.functions.labels import customer_segment, full_name
from tillmetrics.operators.rollups import count_key, live, orders_by_customer, parent
from tillmetrics.plans import Tables


def customer_ltv(tables: Tables, unique_keys: bool = True) -> DataFrame:
    """Orders, revenue, lifetime and yearly value of every customer who bought something.

    A customer with a single order time has no lifetime, hence no yearly value.
    """
    per_customer = orders_by_customer(live(tables["orders"]), unique_keys)
    return ltv_of(per_customer, parent(tables, "customers", unique_keys))


def ltv_of(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from ``orders_by_customer`` of the live orders, or states of them."""
    joined = per_customer.join(customers, "customer_id")
    measured = joined.select(
        "customer_id",
        full_name().alias("customer_name"),
        "customer_tier",
        "country",
        "total_orders",
        to_amount("revenue_cents").alias("total_revenue"),
        ratio(to_amount("revenue_cents"), F.col("priced_orders")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        days_between(F.col("first_order_date"), F.col("last_order_date")).alias(
            "customer_lifetime_days"
        ),
    )
    return measured.withColumns(
        {
            "estimated_annual_clv": ratio(
                F.col("total_revenue"), F.col("customer_lifetime_days")
            )
            * 365.0,
            "customer_segment": customer_segment(F.col("total_orders")),
        }
    )


def customer_ltv_segments(tables: Tables, unique_keys: bool = True) -> DataFrame:
    """Customer means per segment, the order value being a mean of customer means."""
    return segments_of(customer_ltv(tables, unique_keys))


def segments_of(ltv: DataFrame) -> DataFrame:
    return (
        ltv.groupBy("customer_segment")
        .agg(
            F.count("*").alias("customer_count"),
            F.round(F.avg("total_revenue"), 2).alias("avg_total_revenue"),
            F.round(F.avg("estimated_annual_clv"), 2).alias("avg_annual_clv"),
            F.round(F.avg("avg_order_value"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_last("avg_annual_clv"), "customer_segment")
    )


def customer_geography(
    tables: Tables, min_customers: int = 5, unique_keys: bool = True
) -> DataFrame:
    """Customers, orders and revenue per city; customers without orders count too."""
    per_customer = orders_by_customer(live(tables["orders"]), unique_keys)
    customers = parent(tables, "customers", unique_keys).select("customer_id", "country", "city")
    revenue = F.sum("revenue_cents")
    customer_count = count_key("customer_id", unique_keys)
    return (
        customers.join(per_customer, "customer_id", "left")
        .groupBy("country", "city")
        .agg(
            customer_count.alias("customer_count"),
            F.coalesce(F.sum("total_orders"), F.lit(0)).alias("order_count"),
            to_amount(revenue).alias("total_revenue"),
            rounded_amount(revenue, F.sum("priced_orders")).alias("avg_order_value"),
            rounded_amount(revenue, customer_count).alias("revenue_per_customer"),
        )
        .filter(F.col("customer_count") >= min_customers)
        .orderBy(F.desc_nulls_last("total_revenue"), "country", "city")
    )


def tier_summary(tables: Tables) -> DataFrame:
    """Orders and their mean value per customer tier; cancelled orders count."""
    per_customer = orders_by_customer(tables["orders"])
    return (
        per_customer.join(tables["customers"].select("customer_id", "customer_tier"), "customer_id")
        .groupBy("customer_tier")
        .agg(
            F.sum("order_rows").alias("count"),
            ratio(to_amount(F.sum("revenue_cents")), F.sum("priced_orders")).alias(
                "avg_order_value"
            ),
        )
    )
