"""Labels the reports attach to numbers. A NULL number falls to the last label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels of the reports.
VIP_ORDERS = 5
REGULAR_ORDERS = 2
HIGH_MARGIN = 0.4
MEDIUM_MARGIN = 0.2
LOW_STOCK_DAYS = 15
OVERSTOCK_DAYS = 60
HIGH_RISK = 0.3
MEDIUM_RISK = 0.1
RISKY_PAYMENT = 0.5


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """NULL when either part is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def customer_segment(order_count: Column) -> Column:
    return (
        F.when(order_count >= VIP_ORDERS, "VIP")
        .when(order_count >= REGULAR_ORDERS, "Regular")
        .otherwise("New")
    )


def margin_category(margin: Column) -> Column:
    return (
        F.when(margin > HIGH_MARGIN, "High Margin")
        .when(margin > MEDIUM_MARGIN, "Medium Margin")
        .otherwise("Low Margin")
    )


def stock_status(days_of_supply: Column) -> Column:
    return (
        F.when(days_of_supply < LOW_STOCK_DAYS, "Low Stock")
        .when(days_of_supply > OVERSTOCK_DAYS, "Overstocked")
        .otherwise("Optimal Stock")
    )


def risk_category(risk: Column) -> Column:
    return (
        F.when(risk > HIGH_RISK, "High Risk")
        .when(risk > MEDIUM_RISK, "Medium Risk")
        .otherwise("Low Risk")
    )
