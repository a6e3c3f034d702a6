"""SQL of the queries that write tables and read them back."""

from __future__ import annotations

from tillmetrics.oracle.operators import OPERATOR_SQL
from tillmetrics.oracle.quality import issues
from tillmetrics.oracle.reports import REPORT_SQL

_VIEWS = {
    "customers": "v_customers",
    "products": "v_products",
    "orders": "v_orders_full",
    "order_items": "v_order_items",
    "payments": "v_payments",
}


def _loads(steps: dict[str, tuple[str, str]]) -> str:
    """What loading gives, for rows (source) of a table by the step's name."""
    return " UNION ALL ".join(
        f"SELECT '{step}' AS step, count(*) AS row_count, {issues(table)} AS reason FROM {source}"
        for step, (table, source) in steps.items()
    )


_LOAD = f"""
WITH counted AS ({_loads({t: (t, view) for t, view in _VIEWS.items()})})
SELECT step AS table_name, reason = '' AS ok, row_count, reason,
       printf('%.1f%%', CAST(100 * count(*) FILTER (reason = '') OVER () AS DOUBLE)
                        / count(*) OVER ()) AS success_rate
FROM counted
"""

_LOAD_JSON = f"""
WITH counted AS ({_loads({t: (t, view) for t, view in _VIEWS.items()})})
SELECT step AS table_name, reason = '' AS ok,
       printf('%.1f%%', CAST(100 * count(*) FILTER (reason = '') OVER () AS DOUBLE)
                        / count(*) OVER ()) AS success_rate,
       'Loaded ' || count(*) FILTER (reason = '') OVER () || ' of ' || count(*) OVER () || ' tables' AS summary
FROM counted
"""

# Each step's rows, and how many are stored after it: a refused step leaves what was there.
_FAULTY = {
    "orders": ("orders", "v_orders_full"),
    "orders again": (
        "orders",
        "(SELECT * FROM v_orders_full UNION ALL SELECT * FROM v_orders_full WHERE order_id % 3 = 0)",
    ),
    "customers without city": (
        "customers",
        "(SELECT * REPLACE (CASE WHEN customer_id % 11 <> 0 THEN city END AS city) FROM v_customers)",
    ),
    "products below zero": (
        "products",
        "(SELECT * REPLACE (CASE WHEN product_id % 7 = 0 THEN -price ELSE price END AS price) FROM v_products)",
    ),
}
_REFUSED = f"""
WITH loaded AS ({_loads(_FAULTY)}),
again AS (SELECT count(*) AS n FROM v_orders_full WHERE order_id % 3 = 0),
whole AS (SELECT count(*) AS n FROM v_orders_full)
SELECT step, reason = '' AS ok,
       CASE WHEN step = 'orders again' THEN again.n ELSE row_count END AS row_count, reason,
       CASE WHEN starts_with(step, 'orders') THEN whole.n ELSE 0 END AS stored_rows
FROM loaded, again, whole
UNION ALL SELECT 'payments from a file that is not there', false, NULL, 'missing file', 0
"""

FILE_SQL: dict[str, str] = {
    "csv_round_trip_customers": "SELECT * FROM v_customers",
    "csv_round_trip_products": """
SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(cost_price AS DOUBLE) AS cost_price)
FROM v_products""",
    "csv_round_trip_orders": """
SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM v_orders_full""",
    "csv_round_trip_order_items": """
SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(subtotal AS DOUBLE) AS subtotal)
FROM v_order_items""",
    "csv_round_trip_payments": "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM v_payments",
    "stored_customers": "SELECT * FROM v_customers",
    "stored_products": """
SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(cost_price AS DOUBLE) AS cost_price)
FROM v_products""",
    "stored_order_items": """
SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(subtotal AS DOUBLE) AS subtotal)
FROM v_order_items""",
    "append_orders": """
SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount),
       strftime(order_date, '%Y-%m') AS order_month
FROM v_orders_full""",
    "append_ltv_segments": REPORT_SQL["customer_ltv_segments"],
    "append_cohort_activity": REPORT_SQL["cohort_activity"],
    "append_distinct_buyers": """
SELECT strftime(order_date, '%Y-%m') AS span, count(DISTINCT customer_id) AS buyers
FROM v_orders WHERE status <> 'cancelled' GROUP BY 1
UNION ALL
SELECT strftime(order_date, '%Y'), count(DISTINCT customer_id) FROM v_orders WHERE status <> 'cancelled' GROUP BY 1""",
    "append_daily_trends": REPORT_SQL["daily_trends_corrected"],
    "append_references": """
SELECT 'orders' AS table_name, 'reference' AS check_name, 'customer_id' AS column_name,
       count(*) AS violations, count(*) = 0 AS passed
FROM v_orders_full WHERE order_id % 2 = 1 AND (customer_id % 7 = 0 OR customer_id NOT IN (SELECT customer_id FROM v_customers))""",
    "bucketed_order_totals": OPERATOR_SQL["agg_totals_to_parent"],
    "look_up_orders": """
SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount),
       strftime(order_date, '%Y-%m') AS order_month
FROM v_orders_full WHERE customer_id BETWEEN 10 AND 60""",
    "load_refused": _REFUSED,
    "load_report_json": _LOAD_JSON,
    "catalog_tables": """
SELECT c.country, o.status, count(*) AS order_count, CAST(sum(o.total_amount) AS DOUBLE) AS revenue
FROM v_customers c JOIN v_orders o USING (customer_id) GROUP BY c.country, o.status""",
    "stored_orders": """
SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount),
       strftime(order_date, '%Y-%m') AS order_month
FROM v_orders_full""",
    "stored_payments": """
SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount),
       strftime(payment_date, '%Y-%m') AS payment_month
FROM v_payments""",
    "load_report": _LOAD,
    "load_then_segments": REPORT_SQL["customer_ltv_segments"],
    "sql_text": """
SELECT c.customer_tier, count(*) AS order_count, CAST(sum(o.total_amount) AS DOUBLE) AS revenue
FROM v_customers c JOIN v_orders o USING (customer_id)
WHERE o.status <> 'cancelled' GROUP BY c.customer_tier""",
}
