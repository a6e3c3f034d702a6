"""SQL of the operator queries."""

from __future__ import annotations

from tillmetrics.oracle.rounding import amount_per, cents, half_up

AS_OF = "DATE '2001-08-01'"

_DAYS = """days AS (
  SELECT CAST(order_date AS DATE) AS order_day, count(*) AS n, sum(total_amount) AS revenue
  FROM v_orders WHERE status <> 'cancelled' GROUP BY ALL)"""

_STATUSES = "['pending', 'processing', 'shipped', 'delivered', 'cancelled']"

OPERATOR_SQL: dict[str, str] = {
    "filter_not_equal": "SELECT order_id, status FROM v_orders WHERE status <> 'cancelled'",
    "filter_month_text": """
SELECT order_id, strftime(order_date, '%Y-%m') AS order_month FROM v_orders
WHERE strftime(order_date, '%Y-%m') >= '1998-06'""",
    "filter_recent_days": f"""
SELECT order_id, customer_id, order_date FROM v_orders WHERE order_date >= {AS_OF} - 90""",
    "filter_not_null": "SELECT order_id FROM v_orders WHERE order_id IS NOT NULL",
    "filter_compare": "SELECT payment_id, risk_score FROM v_payments WHERE risk_score > 0.5",
    "filter_equal": """
SELECT payment_id, payment_method FROM v_payments WHERE payment_status = 'failed'""",
    "filter_flag_customers": "SELECT customer_id, customer_tier FROM v_customers WHERE is_active",
    "filter_flag_products": "SELECT product_id, category FROM v_products WHERE is_active",
    "project_star_plus": """
SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(cost_price AS DOUBLE) AS cost_price),
       CAST(price - cost_price AS DOUBLE) AS unit_profit
FROM v_products""",
    "lookup_by_key": """
SELECT i.order_item_id, i.product_id, i.quantity, CAST(p.price AS DOUBLE) AS price
FROM v_order_items i JOIN v_products p USING (product_id)""",
    "join_inner": """
SELECT o.order_id, o.customer_id, c.customer_tier, o.status
FROM v_orders o JOIN v_customers c USING (customer_id)""",
    "join_star": """
SELECT o.order_id, i.order_item_id, p.category, c.customer_tier, o.status, i.quantity,
       CAST(i.subtotal AS DOUBLE) AS subtotal
FROM v_orders o JOIN v_order_items i USING (order_id) JOIN v_products p USING (product_id)
JOIN v_customers c USING (customer_id)""",
    "join_left": """
SELECT o.order_id, o.status, p.payment_id, p.payment_status
FROM v_orders o LEFT JOIN v_payments p USING (order_id)""",
    "join_left_on_filter": """
SELECT c.customer_id, o.order_id
FROM v_customers c LEFT JOIN v_orders o
  ON c.customer_id = o.customer_id AND o.status <> 'cancelled'""",
    "join_anti": """
SELECT order_id, status, CAST(total_amount AS DOUBLE) AS total_amount FROM v_orders
WHERE order_id NOT IN (SELECT order_id FROM v_order_items)""",
    "join_aligned": """
SELECT p.payment_id, p.order_id, CAST(p.amount AS DOUBLE) AS amount,
       CAST(o.total_amount AS DOUBLE) AS order_amount,
       CAST(date_diff('microsecond', o.order_date, p.payment_date) AS DOUBLE) / 1000000 / 86400
         AS days_to_payment
FROM v_payments p JOIN v_orders o USING (order_id)""",
    "agg_count": "SELECT status, count(*) AS order_count FROM v_orders GROUP BY status",
    "agg_distinct": """
SELECT status, count(DISTINCT customer_id) AS customer_count FROM v_orders GROUP BY status""",
    "agg_distinct_case": f"""
SELECT count(DISTINCT CASE WHEN order_date >= {AS_OF} - 90 THEN customer_id END)
         AS recent_customers,
       count(DISTINCT CASE WHEN status <> 'cancelled' THEN customer_id END) AS live_customers,
       count(DISTINCT customer_id) AS all_customers
FROM v_orders""",
    "agg_sum_avg": """
SELECT payment_method, CAST(sum(amount) AS DOUBLE) AS total_amount,
       CAST(sum(amount) AS DOUBLE) / count(amount) AS mean_amount
FROM v_payments GROUP BY payment_method""",
    "agg_sum_expression": """
SELECT p.category, CAST(sum(i.quantity * p.cost_price) AS DOUBLE) AS total_cost,
       CAST(sum(i.quantity * (p.price - p.cost_price)) AS DOUBLE) AS total_profit
FROM v_order_items i JOIN v_products p USING (product_id) GROUP BY p.category""",
    "agg_conditional": """
SELECT payment_method,
       CAST(sum(CASE WHEN payment_status = 'failed' THEN 1 ELSE 0 END) AS BIGINT)
         AS failed_payments,
       CAST(sum(CASE WHEN risk_score > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_payments
FROM v_payments GROUP BY payment_method""",
    "agg_pivot_case": "SELECT payment_method, "
    + ", ".join(
        f"CAST(sum(CASE WHEN payment_status = '{s}' THEN amount ELSE 0 END) AS DOUBLE) "
        f"AS {s}_amount"
        for s in ("completed", "failed", "refunded")
    )
    + " FROM v_payments GROUP BY payment_method",
    "agg_min_max": """
SELECT status, min(order_date) AS first_order, max(order_date) AS last_order,
       CAST(date_diff('microsecond', min(order_date), max(order_date)) AS DOUBLE)
         / 1000000 / 86400 AS span_days
FROM v_orders GROUP BY status""",
    "agg_global": """
SELECT count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
FROM v_orders""",
    "agg_two_keys": """
SELECT c.country, c.customer_tier, count(*) AS order_count
FROM v_customers c JOIN v_orders o USING (customer_id) GROUP BY c.country, c.customer_tier""",
    "agg_expression_key": """
SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS order_count,
       CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM v_orders WHERE status <> 'cancelled' GROUP BY ALL""",
    "agg_dependent_columns": """
SELECT c.customer_id, any_value(c.customer_tier) AS customer_tier,
       any_value(c.country) AS country, count(*) AS order_count
FROM v_customers c JOIN v_orders o USING (customer_id) GROUP BY c.customer_id""",
    "agg_two_level": """
WITH per_customer AS (
  SELECT customer_id, count(DISTINCT order_id) AS total_orders, sum(total_amount) AS revenue
  FROM v_orders WHERE status <> 'cancelled' GROUP BY customer_id)
SELECT total_orders, count(*) AS customer_count, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM per_customer GROUP BY total_orders""",
    "agg_having": """
SELECT country, city, count(DISTINCT customer_id) AS customer_count FROM v_customers
GROUP BY country, city HAVING count(DISTINCT customer_id) >= 5""",
    "agg_arithmetic": f"""
SELECT c.customer_tier,
       {amount_per("sum(o.total_amount)", "count(DISTINCT o.customer_id)")} AS revenue_per_buyer,
       count(DISTINCT c.customer_id) - count(DISTINCT o.customer_id) AS customers_without_orders
FROM v_customers c LEFT JOIN v_orders o
  ON c.customer_id = o.customer_id AND o.status <> 'cancelled'
GROUP BY c.customer_tier""",
    "agg_totals_to_parent": """
SELECT o.order_id, o.customer_id, o.order_date, o.status,
       CAST(coalesce(sum(i.subtotal), 0) AS DOUBLE) AS total_amount
FROM v_orders o LEFT JOIN v_order_items i USING (order_id) GROUP BY ALL""",
    "window_partition_max": """
SELECT product_id, category, CAST(price AS DOUBLE) AS price,
       CAST(max(price) OVER (PARTITION BY category) AS DOUBLE) AS category_max_price
FROM v_products""",
    "window_rolling_rows": f"""WITH {_DAYS}
SELECT order_day, CAST(sum(revenue) OVER week AS DOUBLE) / count(revenue) OVER week
         AS mean_revenue,
       CAST(sum(n) OVER week AS DOUBLE) / count(n) OVER week AS mean_orders
FROM days WINDOW week AS (ORDER BY order_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "window_lag": f"""WITH {_DAYS}
SELECT order_day, CAST(revenue AS DOUBLE) AS revenue,
       CAST(lag(revenue, 7) OVER (ORDER BY order_day) AS DOUBLE) AS previous_revenue
FROM days""",
    "window_over_group": """
SELECT customer_id, strftime(order_date, '%Y-%m') AS order_month, count(*) AS monthly_orders,
       min(strftime(order_date, '%Y-%m')) OVER (PARTITION BY customer_id) AS first_month
FROM v_orders WHERE status <> 'cancelled'
GROUP BY customer_id, strftime(order_date, '%Y-%m')""",
    "window_first_value": """
WITH months AS (
  SELECT status, strftime(order_date, '%Y-%m') AS order_month, count(*) AS monthly_orders
  FROM v_orders GROUP BY ALL)
SELECT *, first_value(monthly_orders) OVER (PARTITION BY status ORDER BY order_month)
            AS first_month_orders
FROM months""",
    "topk": """
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_units_sold FROM v_order_items
GROUP BY product_id ORDER BY total_units_sold DESC, product_id LIMIT 20""",
    "sort_keys": """
SELECT country, city, customer_id FROM v_customers ORDER BY country, city, customer_id""",
    "scalar_concat": """
SELECT customer_id, first_name || ' ' || last_name AS customer_name FROM v_customers""",
    "scalar_julianday": """
SELECT payment_id, CAST(date_diff('microsecond', TIMESTAMP '1995-01-01', payment_date) AS DOUBLE)
         / 1000000 / 86400 AS days_since
FROM v_payments""",
    "scalar_calendar": """
SELECT order_id, CAST(order_date AS DATE) AS order_day,
       strftime(order_date, '%Y-%m') AS order_month,
       CAST(isodow(order_date) - 1 AS INT) AS weekday, CAST(month(order_date) AS INT) AS month
FROM v_orders""",
    "scalar_date_offset": f"""
SELECT order_id, {AS_OF} - 30 AS month_before, CAST(order_date AS DATE) + 7 AS week_after,
       order_date + INTERVAL 36 HOUR AS hours_after
FROM v_orders""",
    "scalar_nullif_round": f"""
SELECT order_item_id,
       CAST(subtotal AS DOUBLE) / NULLIF(CAST(quantity - 1 AS DOUBLE), 0) AS per_further_unit,
       {half_up(cents("subtotal"), "quantity - 1", 1)} AS cents_per_further_unit
FROM v_order_items""",
    "scalar_percent_label": f"""
WITH margin AS (
  SELECT product_id, price, cost_price,
         CAST(price - cost_price AS DOUBLE) / NULLIF(CAST(price AS DOUBLE), 0) AS margin
  FROM v_products)
SELECT product_id, {half_up(cents("price - cost_price"), cents("price"), times=100)}
         AS margin_percent,
       CASE WHEN margin > 0.4 THEN 'High Margin' WHEN margin > 0.2 THEN 'Medium Margin'
            ELSE 'Low Margin' END AS margin_category
FROM margin""",
    "scalar_case_label": """
SELECT payment_id, CASE WHEN risk_score > 0.3 THEN 'High Risk'
                        WHEN risk_score > 0.1 THEN 'Medium Risk' ELSE 'Low Risk' END
                     AS risk_category
FROM v_payments""",
    "scalar_int_div": """
SELECT product_id, CAST(stock_quantity // NULLIF(CAST(floor(price) AS BIGINT), 0) * 30 AS BIGINT)
         AS stock_per_price
FROM v_products""",
    "scalar_clamp": f"""
SELECT status,
       {_STATUSES}[1 + greatest(0, least(4, 4 - date_diff('day', CAST(order_date AS DATE),
                                                          {AS_OF}) // 7))] AS expected_status,
       count(*) AS order_count
FROM v_orders GROUP BY ALL""",
    "scalar_text": """
SELECT product_id, substr(product_name, 1, 16) AS short_name,
       array_to_string(list_transform(string_split(product_name, ' '),
                       lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
       replace(subcategory, 'Brand#', '') AS brand_number
FROM v_products""",
    "scalar_lookup_default": """
WITH rules(category, multiplier, low, high) AS (VALUES
  ('Electronics', 1.2, 10, 100), ('Clothing', 1.0, 20, 200), ('Books', 0.7, 50, 500),
  ('Sports', 0.9, 10, 100), ('Home & Garden', 0.8, 15, 150), ('Beauty', 1.1, 25, 250))
SELECT p.product_id,
       CASE WHEN p.category = 'Electronics' AND p.price > 100 THEN 5
            ELSE coalesce(r.low, 10) END AS least_stock,
       CASE WHEN p.category = 'Electronics' AND p.price > 100 THEN 50
            ELSE coalesce(r.high, 100) END AS stock_below,
       CAST(5 * coalesce(r.multiplier, 1.0) AS DOUBLE) AS lowest_price,
       CAST(500 * coalesce(r.multiplier, 1.0) AS DOUBLE) AS highest_price
FROM v_products p LEFT JOIN rules r ON p.category = r.category""",
    "scalar_null_test": """
SELECT customer_tier, count(*) FILTER (loyalty_score IS NULL OR isnan(loyalty_score)) AS missing,
       count(*) AS customer_count
FROM v_customers GROUP BY customer_tier""",
    "scalar_format": f"""
WITH per_customer AS (
  SELECT customer_id, count(*) FILTER (status <> 'cancelled') AS live, count(*) AS n,
         max(order_date) AS last_order
  FROM v_orders GROUP BY customer_id)
SELECT customer_id, printf('%.1f%%', {half_up("live", "n", 1, 100)}) AS live_share,
       strftime(last_order, '%Y-%m-%dT%H:%M:%S') AS last_order
FROM per_customer""",
}
