"""Reports about products: performance, stock, best sellers, category by tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import (
    cents,
    ratio,
    rounded_amount,
    rounded_percent,
    rounded_ratio,
    sum_cents,
    to_amount,
    whole_division,
)
from tillmetrics.functions.labels import margin_category, stock_status
from tillmetrics.operators.rollups import (
    count_key,
    live,
    live_sales_by_product,
    parent,
    sales_by_product,
)
from tillmetrics.plans import REFERENCE, Tables, is_corrected


SUPPLY_DAYS = 30


def _sales(tables: Tables, mode: str) -> DataFrame:
    if is_corrected(mode):
        return live_sales_by_product(tables["order_items"], tables["orders"])
    return sales_by_product(tables["order_items"])


def _with_sales(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Every product, sold or not, with its sales and profit in cents."""
    # Every line of a product carries the same catalogue cost, so cost is units times cost.
    return (
        products.join(sales, "product_id", "left")
        .withColumn("total_cost_cents", F.col("total_units_sold") * cents("cost_price"))
        .withColumn("profit_cents", F.col("revenue_cents") - F.col("total_cost_cents"))
    )


def _with_category_best(df: DataFrame, products: DataFrame, sales: DataFrame) -> DataFrame:
    """Attach the units of the best seller of each row's category.

    A window over a category would bring a third of all products into one task.
    The few maxima are computed apart and joined back; ``df`` uses ``sales`` too,
    and testing all its columns here keeps both uses alike, so that Spark
    aggregates and shuffles the items once.
    """
    sold = F.coalesce("total_units_sold", "revenue_cents").isNotNull()
    if "unique_orders" in sales.columns:
        sold = sold | (F.col("unique_orders") > 0)
    best = (
        sales.filter(sold)
        .join(products.select("product_id", F.col("category").alias("_category")), "product_id")
        .groupBy("_category")
        .agg(F.max("total_units_sold").alias("category_best"))
    )
    return df.join(best, F.col("category").eqNullSafe(F.col("_category")), "left")


def _days_of_supply(mode: str) -> Column:
    stock, best = F.col("stock_quantity"), F.col("category_best")
    if is_corrected(mode):
        return ratio(stock, best) * float(SUPPLY_DAYS)
    return (whole_division(stock, best) * SUPPLY_DAYS).cast("double")


def product_metrics(tables: Tables, mode: str = REFERENCE) -> DataFrame:
    """Sales, profit, margin and days of supply of every product, sold or not.

    Days of supply sets a product's stock against the best seller of its category.
    The customary figure divides whole numbers and counts the items of cancelled
    orders as sold; the corrected one divides exactly and leaves those items out.
    """
    revenue, profit = to_amount("revenue_cents"), to_amount("profit_cents")
    units = F.col("total_units_sold")
    products, sales = tables["products"], _sales(tables, mode)
    sold = _with_sales(products, sales)
    return _with_category_best(sold, products, sales).select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        F.col("price").cast("double").alias("price"),
        F.col("cost_price").cast("double").alias("cost_price"),
        "stock_quantity",
        "total_units_sold",
        revenue.alias("total_revenue"),
        to_amount("total_cost_cents").alias("total_cost"),
        profit.alias("total_profit"),
        F.coalesce("unique_orders", F.lit(0)).alias("unique_orders"),
        ratio(revenue, units).alias("effective_price"),
        ratio(profit, units).alias("profit_per_unit"),
        ratio(profit, revenue).alias("profit_margin"),
        _days_of_supply(mode).alias("days_of_supply"),
    )


def product_performance(tables: Tables, mode: str = REFERENCE, top_n: int = 20) -> DataFrame:
    """The products with the highest revenue, with margin and stock labels."""
    margin = ratio(to_amount("profit_cents"), to_amount("revenue_cents"))
    supply = _days_of_supply(mode)
    if is_corrected(mode):
        rounded_supply = rounded_ratio(
            F.col("stock_quantity"), F.col("category_best"), 1, times=SUPPLY_DAYS
        )
    else:
        rounded_supply = supply
    products, sales = tables["products"], _sales(tables, mode).drop("unique_orders")
    by_revenue = (F.desc_nulls_last("revenue_cents"), F.asc("product_id"))
    top = _with_sales(products, sales).orderBy(*by_revenue).limit(top_n)
    return (
        _with_category_best(top, products, sales)
        .orderBy(*by_revenue)
        .select(
            "category",
            "product_name",
            F.col("price").cast("double").alias("price"),
            "total_units_sold",
            to_amount("revenue_cents").alias("total_revenue"),
            rounded_percent(F.col("profit_cents"), F.col("revenue_cents")).alias(
                "profit_margin_percent"
            ),
            rounded_supply.alias("estimated_days_of_supply"),
            margin_category(margin).alias("margin_category"),
            stock_status(supply).alias("stock_status"),
        )
    )


def top_products(tables: Tables, top_n: int = 5) -> DataFrame:
    """Best-selling product names; products that share a name add up."""
    sales = sales_by_product(tables["order_items"]).select("product_id", "revenue_cents")
    return (
        sales.join(tables["products"].select("product_id", "product_name"), "product_id")
        .groupBy("product_name")
        .agg(to_amount(F.sum("revenue_cents")).alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), "product_name")
        .limit(top_n)
    )


def sales_by_category_tier(tables: Tables, unique_keys: bool = True) -> DataFrame:
    """Orders, customers, units, revenue and profit per category and customer tier.

    Lines are first reduced to one row per order and category, then to one per
    customer and category. An order is in one tier only, so orders and customers
    are counted at those grains instead of by two distinct counts over all lines.
    ``avg_order_value`` is customarily the mean amount of a line.
    """
    catalogue = parent(tables, "products", unique_keys).select(
        "product_id", "category", (cents("price") - cents("cost_price")).alias("unit_profit")
    )
    by_order = (
        tables["order_items"]
        .join(catalogue, "product_id")
        .groupBy("order_id", "category")
        .agg(
            F.count("subtotal").alias("lines"),
            F.sum("quantity").alias("units"),
            sum_cents("subtotal").alias("revenue"),
            F.sum(F.col("quantity") * F.col("unit_profit")).alias("profit"),
        )
    )
    orders = live(parent(tables, "orders", unique_keys)).select("order_id", "customer_id")
    sold = by_order.join(orders, "order_id")
    by_customer = sold.groupBy("customer_id", "category").agg(
        count_key("order_id", unique_keys).alias("orders"),
        *[F.sum(c).alias(c) for c in ("lines", "units", "revenue", "profit")],
    )
    revenue, profit = F.sum("revenue"), F.sum("profit")
    return (
        by_customer.join(
            parent(tables, "customers", unique_keys).select("customer_id", "customer_tier"), "customer_id"
        )
        .groupBy("category", "customer_tier")
        .agg(
            F.sum("orders").alias("order_count"),
            count_key("customer_id", unique_keys).alias("customer_count"),
            F.sum("units").alias("total_units_sold"),
            to_amount(revenue).alias("total_revenue"),
            to_amount(profit).alias("total_profit"),
            rounded_percent(profit, revenue).alias("profit_margin_percent"),
            rounded_amount(revenue, F.sum("lines")).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "category", "customer_tier")
    )
