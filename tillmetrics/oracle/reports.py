"""SQL of the reports."""

from __future__ import annotations

from tillmetrics.oracle.rounding import amount_per, cents, half_up

AS_OF = "DATE '2001-08-01'"
MIN_COHORT = "'1995-01'"

_LTV = """
per_customer AS (
  SELECT c.customer_id, c.first_name || ' ' || c.last_name AS customer_name, c.customer_tier,
         c.country, count(DISTINCT o.order_id) AS total_orders,
         CAST(sum(o.total_amount) AS DOUBLE) AS total_revenue,
         CAST(sum(o.total_amount) AS DOUBLE) / NULLIF(count(o.total_amount), 0)
           AS avg_order_value,
         min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date
  FROM v_orders o JOIN v_customers c USING (customer_id)
  WHERE o.status <> 'cancelled'
  GROUP BY ALL),
lived AS (
  SELECT *, CAST(date_diff('microsecond', first_order_date, last_order_date) AS DOUBLE)
            / 1000000 / 86400 AS customer_lifetime_days
  FROM per_customer),
ltv AS (
  SELECT *, total_revenue / NULLIF(customer_lifetime_days, 0) * 365 AS estimated_annual_clv,
         CASE WHEN total_orders >= 5 THEN 'VIP' WHEN total_orders >= 2 THEN 'Regular'
              ELSE 'New' END AS customer_segment
  FROM lived)
"""


def _product_metrics(corrected: bool) -> str:
    only_live = (
        "WHERE order_id IN (SELECT order_id FROM v_orders WHERE status <> 'cancelled')"
        if corrected
        else ""
    )
    supply = (
        "CAST(stock_quantity AS DOUBLE) / NULLIF(max(units) OVER per_category, 0) * 30"
        if corrected
        else "CAST(stock_quantity // NULLIF(max(units) OVER per_category, 0) * 30 AS DOUBLE)"
    )
    return f"""
sold AS (SELECT * FROM v_order_items {only_live}),
per_product AS (
  SELECT p.product_id, p.product_name, p.category, p.subcategory, p.price, p.cost_price,
         p.stock_quantity, CAST(sum(i.quantity) AS BIGINT) AS units, sum(i.subtotal) AS revenue,
         sum(i.quantity * p.cost_price) AS cost, count(DISTINCT i.order_id) AS unique_orders
  FROM v_products p LEFT JOIN sold i USING (product_id)
  GROUP BY ALL),
metrics AS (
  SELECT product_id, product_name, category, subcategory, CAST(price AS DOUBLE) AS price,
         CAST(cost_price AS DOUBLE) AS cost_price, stock_quantity, units AS total_units_sold,
         CAST(revenue AS DOUBLE) AS total_revenue, CAST(cost AS DOUBLE) AS total_cost,
         CAST(revenue - cost AS DOUBLE) AS total_profit, unique_orders,
         CAST(revenue AS DOUBLE) / NULLIF(CAST(units AS DOUBLE), 0) AS effective_price,
         CAST(revenue - cost AS DOUBLE) / NULLIF(CAST(units AS DOUBLE), 0) AS profit_per_unit,
         CAST(revenue - cost AS DOUBLE) / NULLIF(CAST(revenue AS DOUBLE), 0) AS profit_margin,
         {supply} AS days_of_supply, revenue, cost
  FROM per_product
  WINDOW per_category AS (PARTITION BY category))
"""


def _product_performance(corrected: bool) -> str:
    return f"""WITH {_product_metrics(corrected)}
SELECT category, product_name, price, total_units_sold, total_revenue,
       {half_up(cents("revenue - cost"), cents("revenue"), times=100)} AS profit_margin_percent,
       round(days_of_supply, 1) AS estimated_days_of_supply,
       CASE WHEN profit_margin > 0.4 THEN 'High Margin'
            WHEN profit_margin > 0.2 THEN 'Medium Margin' ELSE 'Low Margin' END
         AS margin_category,
       CASE WHEN days_of_supply < 15 THEN 'Low Stock'
            WHEN days_of_supply > 60 THEN 'Overstocked' ELSE 'Optimal Stock' END AS stock_status
FROM metrics ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 20"""


_DAILY = """
joined AS (
  SELECT CAST(o.order_date AS DATE) AS order_day, o.order_id, o.customer_id, o.total_amount,
         p.amount, p.payment_status
  FROM v_orders o LEFT JOIN v_payments p USING (order_id)
  WHERE o.status <> 'cancelled'),
daily AS (
  SELECT order_day, count(DISTINCT order_id) AS daily_orders,
         count(DISTINCT customer_id) AS daily_customers, sum(total_amount) AS revenue,
         count(total_amount) AS priced, sum(amount) AS paid,
         count(*) FILTER (payment_status = 'failed') AS failed_payments
  FROM joined GROUP BY order_day)
"""

_DAILY_CORRECTED = """
live AS (SELECT CAST(order_date AS DATE) AS order_day, * FROM v_orders
         WHERE status <> 'cancelled'),
sold AS (
  SELECT order_day, count(DISTINCT order_id) AS n_orders,
         count(DISTINCT customer_id) AS n_customers, sum(total_amount) AS revenue,
         count(total_amount) AS priced
  FROM live GROUP BY order_day),
paid AS (
  SELECT order_day, sum(amount) AS paid, count(*) FILTER (payment_status = 'failed') AS failed
  FROM live JOIN v_payments USING (order_id) GROUP BY order_day),
calendar AS (
  SELECT CAST(unnest(generate_series(min(order_day), max(order_day), INTERVAL 1 DAY)) AS DATE)
           AS order_day
  FROM live),
daily AS (
  SELECT order_day, coalesce(n_orders, 0) AS daily_orders,
         coalesce(n_customers, 0) AS daily_customers,
         CASE WHEN n_orders IS NULL THEN 0 ELSE revenue END AS revenue, priced, paid,
         coalesce(failed, 0) AS failed_payments
  FROM calendar LEFT JOIN sold USING (order_day) LEFT JOIN paid USING (order_day))
"""

_ROLLING = """
weeks AS (
  SELECT *, sum(revenue) OVER week AS week_revenue, count(revenue) OVER week AS week_days,
         CAST(sum(daily_orders) OVER week AS DOUBLE) / count(*) OVER week AS weekly_avg_orders,
         lag(revenue, 7) OVER (ORDER BY order_day) AS previous,
         CAST(revenue AS DOUBLE) AS daily_revenue
  FROM daily
  WINDOW week AS (ORDER BY order_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
rolling AS (
  SELECT order_day, daily_orders, daily_customers, daily_revenue,
         daily_revenue / NULLIF(priced, 0) AS avg_order_value,
         CAST(paid AS DOUBLE) AS daily_payments, failed_payments,
         CAST(week_revenue AS DOUBLE) / NULLIF(week_days, 0) AS weekly_avg_revenue,
         weekly_avg_orders, CAST(previous AS DOUBLE) AS revenue_previous_week
  FROM weeks)
"""


def _daily_trends(daily: str) -> str:
    return f"""WITH {daily}, {_ROLLING}
SELECT order_day, daily_orders, daily_customers, daily_revenue,
       {amount_per("week_revenue", "week_days")} AS weekly_avg_revenue,
       {amount_per("revenue", "priced")} AS avg_order_value,
       {half_up(cents("revenue - previous"), cents("previous"), times=100)}
         AS weekly_growth_percent,
       {half_up("failed_payments", "daily_orders", times=100)} AS payment_failure_rate
FROM weeks ORDER BY order_day DESC LIMIT 30"""


_ACTIVITY = """
monthly AS (
  SELECT c.customer_id, c.first_name || ' ' || c.last_name AS customer_name, c.signup_date,
         strftime(o.order_date, '%Y-%m') AS order_month,
         count(DISTINCT o.order_id) AS monthly_orders, sum(o.total_amount) AS spend
  FROM v_customers c JOIN v_orders o USING (customer_id)
  WHERE o.status <> 'cancelled' GROUP BY ALL),
activity AS (
  SELECT *, min(order_month) OVER (PARTITION BY customer_id) AS first_order_month FROM monthly),
cohorts AS (
  SELECT first_order_month AS cohort_month, order_month AS activity_month,
         count(DISTINCT customer_id) AS active_customers,
         CAST(sum(spend) AS DOUBLE) AS cohort_revenue
  FROM activity GROUP BY ALL)
"""


def _payment_risk(risk: str) -> str:
    return f"""WITH outcome AS (
  SELECT payment_method, payment_status, count(*) AS n, sum(amount) AS amount,
         avg(risk_score) AS mean_risk, sum(risk_score) AS risk_sum,
         count(risk_score) AS risk_n
  FROM v_payments GROUP BY ALL),
method AS (
  SELECT payment_method,
         CAST(coalesce(sum(n) FILTER (payment_status = 'completed'), 0) AS BIGINT) AS ok,
         CAST(coalesce(sum(n) FILTER (payment_status = 'failed'), 0) AS BIGINT) AS failed,
         CAST(coalesce(sum(n) FILTER (payment_status = 'refunded'), 0) AS BIGINT) AS refunded,
         CAST(sum(amount) AS DOUBLE) AS total_processed_amount, {risk} AS risk
  FROM outcome GROUP BY payment_method)
SELECT payment_method, ok AS successful_transactions, failed AS failed_transactions,
       refunded AS refunded_transactions, total_processed_amount,
       {half_up("failed", "ok + failed", times=100)} AS failure_rate_percent,
       round(risk, 3) AS avg_risk_score,
       CASE WHEN risk > 0.3 THEN 'High Risk' WHEN risk > 0.1 THEN 'Medium Risk'
            ELSE 'Low Risk' END AS risk_category
FROM method ORDER BY total_processed_amount DESC"""


def _round_large(x: str) -> str:
    """Above 2^52 a DOUBLE has no decimal places; DuckDB's round would alter it."""
    return f"CASE WHEN abs({x}) >= 4503599627370496 THEN {x} ELSE round({x}, 2) END"


def _kpi(figures: str, avg_order_value: str, revenue_per_customer: str) -> str:
    return f"""WITH o AS (
  SELECT count(*) AS n, count(DISTINCT order_id) AS orders,
         count(DISTINCT order_id) FILTER (status <> 'cancelled') AS good,
         sum(CASE WHEN status <> 'cancelled' THEN total_amount ELSE 0 END) AS revenue,
         sum(CASE WHEN status <> 'cancelled' AND order_date >= {AS_OF} - 30
                  THEN total_amount ELSE 0 END) AS recent_revenue,
         count(DISTINCT customer_id) FILTER (order_date >= {AS_OF} - 90) AS recent_customers,
         count(*) FILTER (order_date >= {AS_OF} - 90) AS recent_orders
  FROM v_orders WHERE order_id IS NOT NULL),
c AS (SELECT count(*) AS n, count(DISTINCT customer_id) AS customers FROM v_customers),
p AS (SELECT count(*) AS n, count(DISTINCT product_id) AS products,
             count(DISTINCT product_id) FILTER (stock_quantity > 0) AS in_stock FROM v_products),
y AS (SELECT count(*) AS n,
             sum(CASE WHEN payment_status = 'completed' THEN amount ELSE 0 END) AS completed,
             sum(CASE WHEN payment_status = 'failed' THEN amount ELSE 0 END) AS failed
      FROM v_payments),
figures AS ({figures},
       {half_up(cents("y.failed"), cents("y.completed + y.failed"), times=100)}
         AS payment_failure_rate
  FROM o, c, p, y)
SELECT *, {avg_order_value} AS avg_order_value, {revenue_per_customer} AS revenue_per_customer,
       {half_up("active_customers", "total_customers", times=100)} AS active_customer_rate
FROM figures"""


_KPI_PAIRED = """
SELECT CAST(o.revenue AS DOUBLE) * c.n * p.n * y.n AS total_revenue,
       CAST(o.recent_revenue AS DOUBLE) * c.n * p.n * y.n AS last_30d_revenue,
       o.orders AS total_orders,
       o.good AS successful_orders, c.customers AS total_customers,
       CASE WHEN o.recent_orders > 0 THEN c.customers ELSE 0 END AS active_customers,
       p.products AS total_products, p.in_stock AS in_stock_products,
       CAST(y.completed AS DOUBLE) * o.n * c.n * p.n AS successful_payments,
       CAST(y.failed AS DOUBLE) * o.n * c.n * p.n AS failed_payments"""

_KPI_OWN = """
SELECT CAST(o.revenue AS DOUBLE) AS total_revenue,
       CAST(o.recent_revenue AS DOUBLE) AS last_30d_revenue,
       o.orders AS total_orders, o.good AS successful_orders, c.customers AS total_customers,
       o.recent_customers AS active_customers, p.products AS total_products,
       p.in_stock AS in_stock_products, CAST(y.completed AS DOUBLE) AS successful_payments,
       CAST(y.failed AS DOUBLE) AS failed_payments"""


REPORT_SQL: dict[str, str] = {
    "customer_ltv": f"WITH {_LTV} SELECT * FROM ltv",
    "customer_ltv_segments": f"""WITH {_LTV}
SELECT customer_segment, count(*) AS customer_count,
       round(avg(total_revenue), 2) AS avg_total_revenue,
       round(avg(estimated_annual_clv), 2) AS avg_annual_clv,
       round(avg(avg_order_value), 2) AS avg_order_value
FROM ltv GROUP BY customer_segment ORDER BY avg_annual_clv DESC NULLS LAST""",
    "product_metrics": f"WITH {_product_metrics(False)} "
    "SELECT * EXCLUDE (revenue, cost) FROM metrics",
    "product_metrics_corrected": f"WITH {_product_metrics(True)} "
    "SELECT * EXCLUDE (revenue, cost) FROM metrics",
    "product_performance": _product_performance(False),
    "product_performance_corrected": _product_performance(True),
    "daily_rolling": f"WITH {_DAILY}, {_ROLLING} SELECT * FROM rolling",
    "daily_rolling_corrected": f"WITH {_DAILY_CORRECTED}, {_ROLLING} SELECT * FROM rolling",
    "daily_trends": _daily_trends(_DAILY),
    "daily_trends_corrected": _daily_trends(_DAILY_CORRECTED),
    "order_seasonality": """WITH per_day AS (
  SELECT CAST(order_date AS DATE) AS day, count(*) AS n FROM v_orders GROUP BY ALL)
SELECT CAST(month(day) AS INT) AS month, CAST(isodow(day) - 1 AS INT) AS weekday,
       count(*) AS days, CAST(sum(n) AS BIGINT) AS order_count,
       CAST(sum(n) AS DOUBLE) / count(*) AS orders_per_day,
       isodow(day) >= 6 AS is_weekend, month(day) IN (11, 12) AS is_holiday_season
FROM per_day GROUP BY ALL""",
    "customer_monthly_activity": f"""WITH {_ACTIVITY}
SELECT customer_id, customer_name, signup_date, order_month, monthly_orders,
       CAST(spend AS DOUBLE) AS monthly_spend, first_order_month FROM activity""",
    "cohort_activity": f"WITH {_ACTIVITY} SELECT * FROM cohorts",
    "cohort_retention": f"""WITH {_ACTIVITY}
SELECT cohort_month, activity_month, active_customers, cohort_revenue,
       {half_up("active_customers", "started", times=100)} AS retention_rate_percent
FROM (SELECT *, first_value(active_customers) OVER (
                  PARTITION BY cohort_month ORDER BY activity_month) AS started FROM cohorts)
WHERE cohort_month >= {MIN_COHORT} ORDER BY cohort_month, activity_month""",
    "payment_method_status": """
SELECT payment_method, payment_status, count(*) AS transaction_count,
       CAST(sum(amount) AS DOUBLE) AS total_amount,
       CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_transaction_amount,
       round(avg(risk_score), 9) AS avg_risk_score,
       count(*) FILTER (risk_score > 0.5) AS high_risk_count
FROM v_payments GROUP BY payment_method, payment_status""",
    "payment_risk": _payment_risk("avg(mean_risk)"),
    "payment_risk_corrected": _payment_risk("sum(risk_sum) / sum(risk_n)"),
    "kpi_dashboard": _kpi(
        _KPI_PAIRED,
        _round_large("total_revenue / NULLIF(total_orders, 0)"),
        _round_large("total_revenue / NULLIF(total_customers, 0)"),
    ),
    "kpi_dashboard_corrected": _kpi(
        _KPI_OWN,
        amount_per("CAST(total_revenue AS DECIMAL(18,2))", "total_orders"),
        amount_per("CAST(total_revenue AS DECIMAL(18,2))", "total_customers"),
    ),
    "sales_by_category_tier": f"""
SELECT p.category, c.customer_tier, count(DISTINCT o.order_id) AS order_count,
       count(DISTINCT o.customer_id) AS customer_count,
       CAST(sum(i.quantity) AS BIGINT) AS total_units_sold,
       CAST(sum(i.subtotal) AS DOUBLE) AS total_revenue,
       CAST(sum(i.quantity * (p.price - p.cost_price)) AS DOUBLE) AS total_profit,
       {half_up(cents("sum(i.quantity * (p.price - p.cost_price))"),
                cents("sum(i.subtotal)"), times=100)} AS profit_margin_percent,
       {amount_per("sum(i.subtotal)", "count(i.subtotal)")} AS avg_order_value
FROM v_order_items i JOIN v_products p USING (product_id)
JOIN v_orders o USING (order_id) JOIN v_customers c USING (customer_id)
WHERE o.status <> 'cancelled' GROUP BY p.category, c.customer_tier""",
    "customer_geography": f"""
SELECT c.country, c.city, count(DISTINCT c.customer_id) AS customer_count,
       count(DISTINCT o.order_id) AS order_count,
       CAST(sum(o.total_amount) AS DOUBLE) AS total_revenue,
       {amount_per("sum(o.total_amount)", "count(o.total_amount)")} AS avg_order_value,
       {amount_per("sum(o.total_amount)", "count(DISTINCT c.customer_id)")}
         AS revenue_per_customer
FROM v_customers c LEFT JOIN (SELECT * FROM v_orders WHERE status <> 'cancelled') o
  ON c.customer_id = o.customer_id
GROUP BY c.country, c.city HAVING count(DISTINCT c.customer_id) >= 5""",
    "top_products": """
SELECT p.product_name, CAST(sum(i.subtotal) AS DOUBLE) AS revenue
FROM v_order_items i JOIN v_products p USING (product_id)
GROUP BY p.product_name ORDER BY revenue DESC, p.product_name LIMIT 5""",
    "tier_summary": """
SELECT c.customer_tier, count(*) AS count,
       CAST(sum(o.total_amount) AS DOUBLE) / count(o.total_amount) AS avg_order_value
FROM v_customers c JOIN v_orders o USING (customer_id) GROUP BY c.customer_tier""",
}
