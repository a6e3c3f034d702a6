"""The five tables derived from a TPC-H-like star schema (customer, nation, part, orders, lineitem).

That schema has no payments, stock or cost columns; they follow from its keys by
fixed rules, so that equal inputs give equal tables in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.sources import TableSet

# Read with the declared types: no job to look into file footers, and only these columns.
STAR = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double",
}


def star_tables(spark: SparkSession, folder: str, shipping: bool = False) -> TableSet:
    """The five tables over ``folder/<table>.parquet``.

    ``shipping`` gives ``orders`` its address columns, which cost a join with the
    customers; reports do not use them.
    """

    def read(name: str) -> DataFrame:
        return spark.read.schema(STAR[name]).parquet(f"{folder}/{name}.parquet")

    def customers() -> DataFrame:
        joined = read("customer").join(read("nation"), F.expr("c_nationkey = n_nationkey"))
        return joined.selectExpr(
            "c_custkey AS customer_id",
            "split_part(c_name, '#', 1) AS first_name",
            "split_part(c_name, '#', 2) AS last_name",
            "lower(replace(c_name, '#', '.')) || '@example.com' AS email",
            "DATE'1995-01-01' + CAST(c_custkey % 365 AS int) AS signup_date",
            "CASE WHEN c_acctbal >= 6000 THEN 'premium' ELSE 'standard' END AS customer_tier",
            "n_name AS country",
            "c_mktsegment AS city",
            "c_acctbal / 100 AS loyalty_score",
            "c_custkey % 10 <> 0 AS is_active",
        )

    def products() -> DataFrame:
        # Every category, one that is none of them, and electronics below 100 as well as above.
        named = read("part").withColumn(
            "category",
            F.expr(
                "CASE p_type WHEN 'LARGE' THEN 'Electronics' WHEN 'STANDARD' THEN 'Clothing' "
                "WHEN 'MEDIUM' THEN 'Home & Garden' WHEN 'ECONOMY' THEN 'Books' "
                "WHEN 'PROMO' THEN IF(p_partkey % 2 = 0, 'Sports', 'Outlet') ELSE 'Beauty' END"
            ),
        )
        cheap = "category = 'Electronics' AND p_partkey % 4 = 0"
        priced = named.withColumn(
            "price", F.expr(f"CAST(p_retailprice / IF({cheap}, 10, 1) AS decimal(18,2))")
        )
        return priced.selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            "category",
            "p_brand AS subcategory",
            "price",
            "CAST(price * CAST(0.5 * (1 + p_partkey % 5) AS decimal(4,1)) AS decimal(18,2)) "
            "AS cost_price",
            "p_size * 10 AS stock_quantity",
            "p_brand AS supplier",
            "DATE'1995-01-01' + CAST(p_partkey % 365 AS int) AS creation_date",
            "p_partkey % 20 <> 0 AS is_active",
        )

    def orders() -> DataFrame:
        out = read("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "o_orderdate AS order_date",
            "CASE o_orderstatus WHEN 'P' THEN 'cancelled' WHEN 'F' THEN 'delivered' "
            "ELSE 'processing' END AS status",
            "CAST(o_totalprice AS decimal(18,2)) AS total_amount",
        )
        if not shipping:
            return out
        address = customers().selectExpr(
            "customer_id", "country AS shipping_country", "city AS shipping_city"
        )
        return out.join(address, "customer_id", "left").select(
            "order_id",
            "customer_id",
            "order_date",
            "status",
            "shipping_country",
            "shipping_city",
            "total_amount",
        )

    def order_items() -> DataFrame:
        return read("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS order_item_id",
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "CAST(l_quantity AS int) AS quantity",
            "CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS double) / 100 "
            "AS decimal(18,2)) AS unit_price",
            "CAST(l_extendedprice AS decimal(18,2)) AS subtotal",
        )

    def payments() -> DataFrame:
        # One attempt per order; every failed one is followed by a completed retry, so that
        # some orders have two payments.
        attempts = read("orders").select(
            "*", F.expr("explode(IF(o_orderkey % 20 = 0, array(0, 1), array(0))) AS attempt")
        )
        named = attempts.selectExpr(
            "o_orderkey AS order_id",
            "o_orderkey * 2 + attempt AS payment_id",
            "o_orderdate AS order_date",
            "CAST(o_totalprice AS decimal(18,2)) AS amount",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' "
            "THEN 'debit_card' WHEN '3-MEDIUM' THEN 'paypal' ELSE 'apple_pay' END "
            "AS payment_method",
            "CASE WHEN attempt = 1 THEN 'completed' WHEN o_orderkey % 20 = 0 THEN 'failed' "
            "WHEN o_orderkey % 20 = 1 THEN 'refunded' ELSE 'completed' END AS payment_status",
        )
        return named.selectExpr(
            "payment_id",
            "order_id",
            "payment_method",
            "amount",
            "payment_status",
            "order_date + make_interval(0, 0, 0, 0, CAST(order_id % 23 AS int)) AS payment_date",
            "substr(md5(CAST(payment_id AS string)), 1, 16) AS transaction_id",
            "CAST(CASE payment_method WHEN 'credit_card' THEN 50 WHEN 'debit_card' THEN 200 "
            "WHEN 'paypal' THEN 350 ELSE 450 END + (order_id * 7919) % 200 - 100 AS double) "
            "/ 1000 AS risk_score",
        )

    return TableSet(
        {
            "customers": customers,
            "products": products,
            "orders": orders,
            "order_items": order_items,
            "payments": payments,
        }
    )
