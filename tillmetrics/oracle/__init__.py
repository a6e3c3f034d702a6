"""The registered queries as plain SQL for DuckDB, to check the Spark results against.

Written from the report definitions, not from the Spark code: distinct counts are
spelled out, joins are made before aggregating and windows are used as such.
"""

from __future__ import annotations

import re

# The five tables over the star-schema views; text is the mapping's definition.
TABLE_SQL = {
    "customers": """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               CAST('1995-01-01' AS DATE) + CAST(c_custkey % 365 AS INT) AS signup_date,
               CASE WHEN c_acctbal >= 6000 THEN 'premium' ELSE 'standard' END AS customer_tier,
               n_name AS country, c_mktsegment AS city, c_acctbal / 100 AS loyalty_score,
               c_custkey % 10 <> 0 AS is_active
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, category,
               p_brand AS subcategory, price,
               CAST(price * CAST(0.5 * (1 + p_partkey % 5) AS DECIMAL(4,1)) AS DECIMAL(18,2))
                 AS cost_price,
               p_size * 10 AS stock_quantity, p_brand AS supplier,
               CAST('1995-01-01' AS DATE) + CAST(p_partkey % 365 AS INT) AS creation_date,
               p_partkey % 20 <> 0 AS is_active
        FROM (SELECT *, CAST(p_retailprice / CASE WHEN category = 'Electronics' AND p_partkey % 4 = 0
                             THEN 10 ELSE 1 END AS DECIMAL(18,2)) AS price
              FROM (SELECT *, CASE p_type WHEN 'LARGE' THEN 'Electronics' WHEN 'STANDARD' THEN 'Clothing'
                                          WHEN 'MEDIUM' THEN 'Home & Garden' WHEN 'ECONOMY' THEN 'Books'
                                          WHEN 'PROMO' THEN CASE WHEN p_partkey % 2 = 0 THEN 'Sports'
                                                                 ELSE 'Outlet' END
                                          ELSE 'Beauty' END AS category FROM part))""",
    "orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
               CASE o_orderstatus WHEN 'P' THEN 'cancelled' WHEN 'F' THEN 'delivered'
                    ELSE 'processing' END AS status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
        FROM orders""",
    "order_items": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
               CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS DOUBLE) / 100
                    AS DECIMAL(18,2)) AS unit_price,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal
        FROM lineitem""",
    "payments": """
        SELECT payment_id, order_id, payment_method, amount, payment_status,
               order_date + to_hours(CAST(order_id % 23 AS INT)) AS payment_date,
               substr(md5(CAST(payment_id AS VARCHAR)), 1, 16) AS transaction_id,
               CAST(CASE payment_method WHEN 'credit_card' THEN 50 WHEN 'debit_card' THEN 200
                         WHEN 'paypal' THEN 350 ELSE 450 END
                    + (order_id * 7919) % 200 - 100 AS DOUBLE) / 1000 AS risk_score
        FROM (SELECT o_orderkey * 2 + attempt AS payment_id, o_orderkey AS order_id,
                     o_orderdate AS order_date, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
                     CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card'
                          WHEN '2-HIGH' THEN 'debit_card' WHEN '3-MEDIUM' THEN 'paypal'
                          ELSE 'apple_pay' END AS payment_method,
                     CASE WHEN attempt = 1 THEN 'completed'
                          WHEN o_orderkey % 20 = 0 THEN 'failed'
                          WHEN o_orderkey % 20 = 1 THEN 'refunded'
                          ELSE 'completed' END AS payment_status
              FROM orders JOIN (VALUES (0), (1)) AS tries(attempt)
                ON attempt = 0 OR o_orderkey % 20 = 0)""",
    "orders_full": """
        SELECT o.order_id, o.customer_id, o.order_date, o.status, c.country AS shipping_country,
               c.city AS shipping_city, o.total_amount
        FROM v_orders o LEFT JOIN v_customers c USING (customer_id)""",
}


def _tables_in(query: str) -> set[str]:
    """The ``v_<table>`` views a query needs, directly or through another one."""
    needed: set[str] = set()
    texts = [query]
    while texts:
        text = texts.pop()
        for name in TABLE_SQL:
            if name not in needed and re.search(rf"\bv_{name}\b", text):
                needed.add(name)
                texts.append(TABLE_SQL[name])
    return needed


def with_tables(query: str) -> str:
    """Put the definitions of the tables a query names in front of it."""
    needed = _tables_in(query)
    definitions = [f"v_{name} AS ({text})" for name, text in TABLE_SQL.items() if name in needed]
    query = query.strip()
    if query.upper().startswith("WITH "):
        return "WITH " + ",\n".join([*definitions, query[5:].strip()])
    return "WITH " + ",\n".join(definitions) + "\n" + query


def all_sql() -> dict[str, str]:
    from tillmetrics.oracle.files import FILE_SQL
    from tillmetrics.oracle.operators import OPERATOR_SQL
    from tillmetrics.oracle.quality import QUALITY_SQL
    from tillmetrics.oracle.reports import REPORT_SQL

    every = {**REPORT_SQL, **OPERATOR_SQL, **QUALITY_SQL, **FILE_SQL}
    return {name: with_tables(sql) for name, sql in every.items()}
