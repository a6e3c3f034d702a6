"""Sorting and top rows. Every order ends in a unique column, so that results repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.operators.rollups import sales_by_product
from tillmetrics.plans import Tables


def best_selling_products(tables: Tables, n: int) -> DataFrame:
    """Each task keeps its own top rows; no full sort."""
    sales = sales_by_product(tables["order_items"]).select("product_id", "total_units_sold")
    return sales.orderBy(F.desc_nulls_last("total_units_sold"), "product_id").limit(n)


def customers_by_place(tables: Tables) -> DataFrame:
    places = tables["customers"].select("country", "city", "customer_id")
    return places.orderBy("country", "city", "customer_id")
