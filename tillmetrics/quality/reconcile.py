"""Checks of tables against each other: order totals, payments, prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import cents, to_amount
from tillmetrics.operators.rollups import CANCELLED, items_by_order
from tillmetrics.plans import Tables
from tillmetrics.quality import stack
from tillmetrics.quality.rows import Rule, count_violations

# The rules orders, payments and prices were made by.
PAID_WITHIN_HOURS = 24
CANCELLED_OUTCOMES = ("refunded", "failed")
LIVE_OUTCOMES = ("completed", "failed")
DISCOUNT_RANGE = (80, 100)  # charged price, percent of catalogue price
COST_RANGE = (30, 70)  # cost, percent of catalogue price
PRICE_RANGE = (5, 500)  # before the category's multiplier
EXPENSIVE = 100  # price above which electronics are stocked less
STOCK_RANGES = {  # from, below
    "Electronics": (10, 100),
    "Clothing": (20, 200),
    "Books": (50, 500),
    "Sports": (10, 100),
    "Home & Garden": (15, 150),
    "Beauty": (25, 250),
}
EXPENSIVE_ELECTRONICS_STOCK = (5, 50)
DEFAULT_STOCK = (10, 100)
PRICE_MULTIPLIERS = {
    "Electronics": 1.2,
    "Beauty": 1.1,
    "Clothing": 1.0,
    "Sports": 0.9,
    "Home & Garden": 0.8,
    "Books": 0.7,
}
DEFAULT_MULTIPLIER = 1.0


def lookup(key: str, values: dict[str, float], default: float) -> str:
    """SQL for the value a fixed table gives for ``key``, or the default."""
    branches = " ".join(f"WHEN '{name}' THEN {value}" for name, value in values.items())
    return f"CASE {key} {branches} ELSE {default} END"


def order_reconciliation(tables: Tables) -> DataFrame:
    """Each order's total next to the sum of its lines, with a verdict.

    Rounding may move the sum by a cent per line.
    """
    orders = tables["orders"].select("order_id", cents("total_amount").alias("total_cents"))
    difference = F.col("total_cents") - F.col("items_cents")
    verdict = (
        F.when(F.col("line_count").isNull(), "no_items")
        .when(F.abs(difference) <= F.col("line_count"), "match")
        .otherwise("mismatch")
    )
    return orders.join(items_by_order(tables["order_items"]), "order_id", "left").select(
        "order_id",
        to_amount("total_cents").alias("total_amount"),
        to_amount("items_cents").alias("items_total"),
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
        to_amount(difference).alias("difference"),
        verdict.alias("verdict"),
    )


def order_reconciliation_summary(tables: Tables) -> DataFrame:
    return (
        order_reconciliation(tables)
        .groupBy("verdict")
        .agg(F.count("*").alias("order_count"))
    )


def orders_with_item_totals(tables: Tables) -> DataFrame:
    """Orders with their total replaced by the sum of their lines; zero without lines."""
    items = items_by_order(tables["order_items"])
    return (
        tables["orders"]
        .join(items, "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "order_date",
            "status",
            to_amount(F.coalesce("items_cents", F.lit(0))).alias("total_amount"),
        )
    )


def payments_with_orders(tables: Tables) -> DataFrame:
    """Payments next to amount, time and status of their order; NULL without an order."""
    orders = tables["orders"].select(
        "order_id",
        F.col("total_amount").alias("order_amount"),
        "order_date",
        F.col("status").alias("order_status"),
    )
    return tables["payments"].join(orders, "order_id", "left")


def _among(values: tuple[str, ...]) -> str:
    return f"({', '.join(repr(v) for v in values)})"


def payment_rules() -> list[Rule]:
    return [
        Rule("order_amount", "amount", "amount <> order_amount"),
        Rule(
            "payment_window",
            "payment_date",
            "payment_date <= order_date OR "
            f"payment_date >= order_date + INTERVAL {PAID_WITHIN_HOURS} HOURS",
        ),
        Rule(
            "order_status",
            "payment_status",
            f"payment_status NOT IN {_among(CANCELLED_OUTCOMES)} AND order_status = '{CANCELLED}' "
            f"OR payment_status NOT IN {_among(LIVE_OUTCOMES)} AND order_status <> '{CANCELLED}'",
        ),
    ]


def check_payments(tables: Tables) -> DataFrame:
    return count_violations(payments_with_orders(tables), "payments", payment_rules())


def _outside(part: str, whole: str, percents: tuple[int, int]) -> str:
    """``part`` is not within ``percents`` of ``whole``, half a cent of rounding allowed."""
    low, high = percents
    return (
        f"{part} < {whole} * {low / 100:.2f} - 0.005 OR {part} > {whole} * {high / 100:.2f} + 0.005"
    )


def stock_range() -> tuple[str, str]:
    """SQL for the least stock of a product and the stock it stays below."""
    low, high = (
        f"IF(category = 'Electronics' AND price > {EXPENSIVE}, "
        f"{EXPENSIVE_ELECTRONICS_STOCK[end]}, "
        + lookup("category", {c: r[end] for c, r in STOCK_RANGES.items()}, DEFAULT_STOCK[end])
        + ")"
        for end in (0, 1)
    )
    return low, high


def price_range() -> tuple[str, str]:
    """SQL for the lowest and highest catalogue price of a product."""
    multiplier = lookup("category", PRICE_MULTIPLIERS, DEFAULT_MULTIPLIER)
    low, high = PRICE_RANGE
    return f"{low} * {multiplier}", f"{high} * {multiplier}"


def product_rules() -> list[Rule]:
    least, below = stock_range()
    lowest, highest = price_range()
    return [
        Rule("price_range", "price", f"price < {lowest} OR price > {highest}"),
        Rule("cost_range", "cost_price", _outside("cost_price", "price", COST_RANGE)),
        Rule(
            "stock_range",
            "stock_quantity",
            f"stock_quantity < {least} OR stock_quantity >= {below}",
        ),
    ]


def item_price_rules() -> list[Rule]:
    return [Rule("discount_range", "unit_price", _outside("unit_price", "price", DISCOUNT_RANGE))]


def check_pricing(tables: Tables) -> DataFrame:
    """Catalogue prices against cost and stock ranges, charged prices against the catalogue."""
    prices = tables["products"].select("product_id", "price")
    items = tables["order_items"].join(prices, "product_id")
    return stack(
        [
            count_violations(tables["products"], "products", product_rules()),
            count_violations(items, "order_items", item_price_rules()),
        ]
    )
