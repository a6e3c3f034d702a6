"""Reports over random tables with NULLs, gaps, unsold goods and keys with a third of all rows."""

import datetime as dt
import random

import duckdb
import pytest

from tests import comparing
from tests.shop import shop
from tillmetrics.oracle.quality import QUALITY_SQL
from tillmetrics.oracle.reports import REPORT_SQL
from tillmetrics.plans import CORRECTED, cohorts, customers, kpi, payments, products, trends
from tillmetrics.quality import keys, reconcile

AS_OF = dt.date(2001, 8, 1)  # the day the SQL is written for

REPORTS = {
    "customer_ltv": customers.customer_ltv,
    "customer_ltv_segments": customers.customer_ltv_segments,
    "product_metrics": products.product_metrics,
    "product_metrics_corrected": lambda t: products.product_metrics(t, CORRECTED),
    "product_performance": products.product_performance,
    "product_performance_corrected": lambda t: products.product_performance(t, CORRECTED),
    "daily_rolling": trends.daily_rolling,
    "daily_rolling_corrected": lambda t: trends.daily_rolling(t, CORRECTED),
    "daily_trends": trends.daily_trends,
    "daily_trends_corrected": lambda t: trends.daily_trends(t, CORRECTED),
    "order_seasonality": trends.order_seasonality,
    "customer_monthly_activity": cohorts.customer_monthly_activity,
    "cohort_activity": cohorts.cohort_activity,
    "cohort_retention": lambda t: cohorts.cohort_retention(t, "1995-01"),
    "payment_method_status": payments.payment_method_status,
    "payment_risk": payments.payment_risk,
    "payment_risk_corrected": lambda t: payments.payment_risk(t, CORRECTED),
    "kpi_dashboard": lambda t: kpi.kpi_dashboard(t, AS_OF),
    "kpi_dashboard_corrected": lambda t: kpi.kpi_dashboard(t, AS_OF, CORRECTED),
    "sales_by_category_tier": products.sales_by_category_tier,
    "customer_geography": customers.customer_geography,
    "top_products": products.top_products,
    "tier_summary": customers.tier_summary,
    "dq_unique": keys.check_unique,
    "dq_fk": keys.check_references,
    "dq_order_reconciliation": reconcile.order_reconciliation,
    "dq_payment_reconciliation": reconcile.check_payments,
}
SQL = {**REPORT_SQL, **QUALITY_SQL}


def random_shop(spark, seed, n_orders=600):
    r = random.Random(seed)

    def skewed(n):  # one key owns a third of the rows
        return 1 if r.random() < 1 / 3 else r.randint(1, n)

    def some(value, share=0.03):
        return None if r.random() < share else value

    def money(low, high):
        return f"{r.randint(low * 100, high * 100) / 100:.2f}"

    start = dt.datetime(2001, 5, 1)
    people = [
        {
            "customer_tier": r.choice(["standard", "premium"]),
            "country": r.choice(["Peru", "Chad", None]),
            "city": r.choice("ABC"),
            "last_name": some(f"L{i}"),
        }
        for i in range(60)
    ]
    goods = [
        {
            "product_name": f"P{r.randint(1, 12)}",
            "category": "Books" if i < 7 else r.choice(["Sports", "Toys", None]),
            "price": money(5, 300),
            "cost_price": money(1, 200),
            "stock_quantity": some(r.randint(0, 400)),
        }
        for i in range(25)
    ]
    orders = [
        {
            "customer_id": some(skewed(65)),
            "order_date": start
            + dt.timedelta(days=r.choice([0, r.randint(0, 40), r.randint(60, 100)]),
                           seconds=r.randint(0, 86399), microseconds=r.choice([0, 250000])),
            "status": some(r.choice(["delivered", "shipped", "pending", "cancelled"])),
            "total_amount": some(money(0, 500)),
        }
        for _ in range(n_orders)
    ]
    lines = [
        {
            "order_id": skewed(n_orders + 10),
            "product_id": skewed(24),  # the last product is never sold
            "quantity": some(r.randint(0, 9)),
            "unit_price": money(1, 300),
            "subtotal": some(money(0, 900)),
        }
        for _ in range(3 * n_orders)
    ]
    paid = [
        {
            "order_id": skewed(n_orders + 5),
            "payment_method": r.choice(["paypal", "credit_card", "debit_card"]),
            "payment_status": r.choice(["completed", "completed", "failed", "refunded"]),
            "amount": some(money(1, 500)),
            "payment_date": start + dt.timedelta(hours=r.randint(0, 2400)),
            "risk_score": some(round(r.gauss(0.1, 0.3), 3)),
        }
        for _ in range(n_orders)
    ]
    return shop(
        spark, customers=people, products=goods, orders=orders, order_items=lines, payments=paid
    )


@pytest.fixture(scope="module", params=[1, 2])
def both(request, spark):
    tables = random_shop(spark, request.param)
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"v_{name}", df.toArrow())
    yield tables, con
    con.close()


@pytest.mark.parametrize("name", REPORTS)
def test_equals_sql(both, name):
    tables, con = both
    mine = comparing.spark_table(REPORTS[name](tables))
    assert comparing.difference(mine, comparing.duck_table(con, SQL[name])) == ""


def test_large_shuffles_split_a_hot_key_and_keep_the_result(spark):
    """With tiny skew thresholds and no broadcasts, every join runs the way large ones do."""
    tables = random_shop(spark, 3)
    names = ["sales_by_category_tier", "product_metrics_corrected", "daily_rolling", "customer_ltv"]
    before = {n: comparing.spark_table(REPORTS[n](tables)) for n in names}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for n in names:
            df = REPORTS[n](tables)
            assert comparing.difference(before[n], comparing.spark_table(df)) == ""
            if n == "sales_by_category_tier":  # lines of the hot product
                assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
