"""The edge cases of the reports on hand-built tables."""

import datetime as dt
from decimal import Decimal

import pytest

from tests.shop import by, rows, shop
from tillmetrics.plans import CORRECTED, cohorts, customers, kpi, payments, products, trends


def day(text):
    return dt.datetime.fromisoformat(text)


def test_lifetime_counts_fractions_of_a_day(spark):
    tables = shop(
        spark,
        customers=[{}],
        orders=[
            {"order_date": day("2023-01-01 00:00:00"), "total_amount": "30.10"},
            {"order_date": day("2023-01-02 12:00:00"), "total_amount": "20.20"},
        ],
    )
    (row,) = rows(customers.customer_ltv(tables))
    assert row["customer_name"] == "Ann Lee"
    assert row["customer_lifetime_days"] == 1.5
    assert row["total_revenue"] == 50.3
    assert row["avg_order_value"] == 25.15
    assert row["estimated_annual_clv"] == pytest.approx(50.3 / 1.5 * 365)
    assert row["customer_segment"] == "Regular"


def test_single_order_customers_have_no_yearly_value_and_sort_last(spark):
    orders = [{"customer_id": 1, "order_date": day(f"2023-01-0{d}")} for d in range(1, 6)]
    orders += [{"customer_id": 2}, {"customer_id": 3, "status": "cancelled"}, {"customer_id": 9}]
    tables = shop(spark, customers=[{}, {}, {}], orders=orders)
    segments = rows(customers.customer_ltv_segments(tables))
    assert [s["customer_segment"] for s in segments] == ["VIP", "New"]
    assert segments[1]["avg_annual_clv"] is None
    # Customer 3 only cancelled and customer 9 does not exist.
    assert [s["customer_count"] for s in segments] == [1, 1]


def test_null_name_part_gives_null_name(spark):
    tables = shop(spark, customers=[{"last_name": None}], orders=[{}])
    assert rows(customers.customer_ltv(tables))[0]["customer_name"] is None


def test_days_of_supply_divides_whole_numbers(spark):
    tables = shop(
        spark,
        products=[{"stock_quantity": 46, "category": "A"}, {"category": "A"}, {"category": "B"}],
        order_items=[{"product_id": 1, "quantity": 14, "subtotal": 140}],
        orders=[{}],
    )
    metrics = by(products.product_metrics(tables), "product_id")
    assert metrics[1]["days_of_supply"] == 90.0  # 46 div 14 is 3
    assert metrics[2]["days_of_supply"] == 210.0  # 100 div 14 is 7: the category's best seller
    assert metrics[3]["days_of_supply"] is None  # nothing sold in B
    corrected = by(products.product_metrics(tables, CORRECTED), "product_id")
    assert corrected[1]["days_of_supply"] == pytest.approx(46 / 14 * 30)


def test_unsold_products_keep_nulls_and_fall_to_the_last_labels(spark):
    tables = shop(spark, products=[{}, {"product_name": "Sold"}], orders=[{}],
                  order_items=[{"product_id": 2, "subtotal": 20}])
    metrics = by(products.product_metrics(tables), "product_id")
    assert metrics[1]["total_units_sold"] is None and metrics[1]["total_revenue"] is None
    assert metrics[1]["unique_orders"] == 0
    best = rows(products.product_performance(tables))
    assert [r["product_name"] for r in best] == ["Sold", "Thing"]
    assert best[1]["margin_category"] == "Low Margin"
    assert best[0]["margin_category"] == "High Margin"


def test_products_without_category_share_one(spark):
    tables = shop(
        spark,
        products=[{"category": None, "stock_quantity": 20}, {"category": None}],
        orders=[{}],
        order_items=[{"product_id": 2, "quantity": 5}],
    )
    metrics = by(products.product_metrics(tables), "product_id")
    assert metrics[1]["days_of_supply"] == 120.0
    assert metrics[2]["days_of_supply"] == 600.0


def test_no_category_label_for_missing_supply(spark):
    tables = shop(spark, products=[{}])
    (row,) = rows(products.product_performance(tables))
    assert row["stock_status"] == "Optimal Stock" and row["estimated_days_of_supply"] is None


def test_cancelled_items_count_as_sold_unless_corrected(spark):
    tables = shop(
        spark,
        products=[{}],
        orders=[{}, {"status": "cancelled"}],
        order_items=[{"order_id": 1, "quantity": 2}, {"order_id": 2, "quantity": 3}],
    )
    assert rows(products.product_metrics(tables))[0]["total_units_sold"] == 5
    assert rows(products.product_metrics(tables, CORRECTED))[0]["total_units_sold"] == 2


def test_zero_units_and_revenue_give_null_ratios(spark):
    tables = shop(spark, products=[{}], orders=[{}],
                  order_items=[{"quantity": 0, "subtotal": 0}])
    (row,) = rows(products.product_metrics(tables))
    assert row["effective_price"] is None and row["profit_margin"] is None
    assert row["days_of_supply"] is None


def test_second_payment_counts_an_order_twice_unless_corrected(spark):
    tables = shop(
        spark,
        orders=[{"total_amount": 100}, {"total_amount": 50}],
        payments=[
            {"order_id": 1, "payment_status": "failed", "amount": 100},
            {"order_id": 1, "amount": 100},
        ],
    )
    (row,) = rows(trends.daily_rolling(tables))
    assert row["daily_orders"] == 2 and row["daily_customers"] == 1
    assert row["daily_revenue"] == 250.0
    assert row["avg_order_value"] == pytest.approx(250 / 3)
    assert row["daily_payments"] == 200.0 and row["failed_payments"] == 1
    (row,) = rows(trends.daily_rolling(tables, CORRECTED))
    assert row["daily_revenue"] == 150.0 and row["avg_order_value"] == 75.0


def _orders_on(days, amount=100):
    return [{"order_date": dt.datetime(2023, 1, 1, 9) + dt.timedelta(days=d),
             "total_amount": amount + d} for d in days]


def test_weeks_are_rows_unless_corrected(spark):
    tables = shop(spark, orders=_orders_on([0, 1, 2, 3, 4, 5, 6, 9]))
    last = rows(trends.daily_trends(tables))[0]
    assert last["order_day"] == dt.date(2023, 1, 10)
    # The seventh row before has the first day; three days without orders are skipped.
    assert last["weekly_growth_percent"] == 9.0
    week = (101 + 102 + 103 + 104 + 105 + 106 + 109) / 7
    assert last["weekly_avg_revenue"] == pytest.approx(round(week, 2))
    last = rows(trends.daily_trends(tables, CORRECTED))[0]
    assert last["weekly_growth_percent"] == pytest.approx(round((109 - 102) / 102 * 100, 2))
    assert last["weekly_avg_revenue"] == pytest.approx(round((103 + 104 + 105 + 106 + 109) / 7, 2))


def test_first_days_average_fewer_rows_and_have_no_growth(spark):
    tables = shop(spark, orders=_orders_on(range(9)))
    by_day = by(trends.daily_trends(tables), "order_day")
    assert by_day[dt.date(2023, 1, 1)]["weekly_avg_revenue"] == 100.0
    assert by_day[dt.date(2023, 1, 2)]["weekly_avg_revenue"] == 100.5
    assert by_day[dt.date(2023, 1, 7)]["weekly_growth_percent"] is None
    assert by_day[dt.date(2023, 1, 8)]["weekly_growth_percent"] == 7.0


@pytest.mark.parametrize("mode", ["reference", CORRECTED])
@pytest.mark.parametrize("gap", [0, 3, 40])
def test_newest_days_equal_the_tail_of_all_days(spark, mode, gap):
    """Looking only at the needed days changes nothing, with gaps before or among them."""
    days = [d for d in range(60)] + [60 + gap + d for d in range(35) if d % 9 != 4]
    tables = shop(spark, orders=_orders_on(days))
    every = by(trends.daily_rolling(tables, mode), "order_day")
    newest = rows(trends.daily_trends(tables, mode))
    assert [r["order_day"] for r in newest] == sorted(every, reverse=True)[:30]
    for r in newest:
        full = every[r["order_day"]]
        assert r["daily_revenue"] == full["daily_revenue"]
        assert r["weekly_avg_revenue"] == pytest.approx(full["weekly_avg_revenue"], abs=0.0051)
        previous = full["revenue_previous_week"]
        if previous:
            growth = (full["daily_revenue"] - previous) / previous * 100
            assert r["weekly_growth_percent"] == pytest.approx(growth, abs=0.0051)
        else:
            assert r["weekly_growth_percent"] is None


def test_orders_without_date_form_a_day_of_their_own(spark):
    tables = shop(spark, orders=[{"order_date": None}, *_orders_on([0])])
    days = [r["order_day"] for r in rows(trends.daily_trends(tables))]
    assert days == [dt.date(2023, 1, 1), None]


def test_retention_starts_at_100_and_skips_idle_months(spark):
    def order(customer, month):
        return {"customer_id": customer, "order_date": day(f"{month}-15"), "total_amount": 10}

    orders = [order(1, "2023-01"), order(1, "2023-03"), order(2, "2023-01"), order(3, "2023-02"),
              order(4, "2022-12"), order(4, "2023-01"),
              {**order(3, "2022-11"), "status": "cancelled"}]
    tables = shop(spark, customers=[{}] * 4, orders=orders)
    result = [tuple(r.values()) for r in rows(cohorts.cohort_retention(tables))]
    assert result == [
        ("2023-01", "2023-01", 2, 20.0, 100.0),
        ("2023-01", "2023-03", 1, 10.0, 50.0),
        ("2023-02", "2023-02", 1, 10.0, 100.0),
    ]


def test_risk_is_a_mean_of_means_unless_corrected(spark):
    tables = shop(
        spark,
        payments=[{"risk_score": 0.1}] * 3 + [{"risk_score": 0.7, "payment_status": "failed"}],
    )
    (row,) = rows(payments.payment_risk(tables))
    assert row["avg_risk_score"] == 0.4 and row["risk_category"] == "High Risk"
    assert row["failure_rate_percent"] == 25.0
    (row,) = rows(payments.payment_risk(tables, CORRECTED))
    assert row["avg_risk_score"] == 0.25 and row["risk_category"] == "Medium Risk"


def test_only_refunds_have_no_failure_rate(spark):
    tables = shop(spark, payments=[{"payment_status": "refunded"}])
    (row,) = rows(payments.payment_risk(tables))
    assert row["failure_rate_percent"] is None and row["total_processed_amount"] == 100.0


AS_OF = dt.date(2023, 6, 30)


def _kpi_shop(spark, **changes):
    tables = {
        "customers": [{}, {}, {}],
        "products": [{}, {"stock_quantity": 0}],
        "orders": [
            {"order_date": day("2023-06-01"), "total_amount": 100},
            {"order_date": day("2023-04-15"), "total_amount": 50, "customer_id": 2},
            {"order_date": day("2022-04-15"), "total_amount": 25, "customer_id": 3},
            {"order_date": day("2023-06-29"), "status": "cancelled", "total_amount": 7},
        ],
        "payments": [{"amount": 60}, {"amount": 20, "payment_status": "failed"},
                     {"payment_status": "refunded"}],
    }
    return shop(spark, **{**tables, **changes})


def test_kpis_pair_all_tables_unless_corrected(spark):
    tables = _kpi_shop(spark)
    (row,) = rows(kpi.kpi_dashboard(tables, AS_OF))
    pairs = 3 * 2 * 3
    assert row["total_revenue"] == 175.0 * pairs and row["last_30d_revenue"] == 100.0 * pairs
    assert row["successful_payments"] == 60.0 * 4 * 3 * 2
    assert (row["total_orders"], row["successful_orders"]) == (4, 3)
    assert (row["total_customers"], row["active_customers"]) == (3, 3)
    assert (row["total_products"], row["in_stock_products"]) == (2, 1)
    assert row["payment_failure_rate"] == 25.0 and row["active_customer_rate"] == 100.0
    (row,) = rows(kpi.kpi_dashboard(tables, AS_OF, CORRECTED))
    assert row["total_revenue"] == 175.0 and row["last_30d_revenue"] == 100.0
    assert row["active_customers"] == 2 and row["active_customer_rate"] == 66.67
    assert row["avg_order_value"] == 43.75 and row["revenue_per_customer"] == 58.33


def test_kpis_of_pairs_with_an_empty_table(spark):
    (row,) = rows(kpi.kpi_dashboard(_kpi_shop(spark, products=[]), AS_OF))
    assert row["total_revenue"] is None and row["successful_payments"] is None
    assert row["total_orders"] == 0 and row["total_customers"] == 0
    assert row["active_customer_rate"] is None and row["payment_failure_rate"] is None


def test_kpis_without_recent_orders(spark):
    (row,) = rows(kpi.kpi_dashboard(_kpi_shop(spark), dt.date(2030, 1, 1)))
    assert row["active_customers"] == 0 and row["last_30d_revenue"] == 0.0


def test_sales_count_orders_and_customers_once(spark):
    tables = shop(
        spark,
        customers=[{}, {"customer_tier": "premium"}],
        products=[{"price": 10, "cost_price": 4}, {"price": 8, "cost_price": 9}],
        orders=[{}, {}, {"customer_id": 2}, {"status": "cancelled"}],
        order_items=[
            {"order_id": 1, "quantity": 2, "subtotal": 18},
            {"order_id": 1, "product_id": 2, "quantity": 1, "subtotal": 8},
            {"order_id": 2, "quantity": 1, "subtotal": 10},
            {"order_id": 3, "quantity": 1, "subtotal": 10},
            {"order_id": 4, "quantity": 9, "subtotal": 90},
        ],
    )
    for unique_keys in (True, False):
        result = by(products.sales_by_category_tier(tables, unique_keys), "customer_tier")
        standard = result["standard"]
        assert (standard["order_count"], standard["customer_count"]) == (2, 1)
        assert standard["total_units_sold"] == 4 and standard["total_revenue"] == 36.0
        assert standard["total_profit"] == 2 * 6 - 1 + 6  # catalogue prices, not charged ones
        assert standard["profit_margin_percent"] == round(17 * 100 / 36, 2)
        assert standard["avg_order_value"] == 12.0  # per line
        assert result["premium"]["order_count"] == 1


def test_geography_keeps_customers_without_orders_and_groups_without_revenue(spark):
    people = [{"city": "Lima"}] * 5 + [{"city": "Cusco"}] * 5 + [{"city": "Puno"}] * 4
    tables = shop(spark, customers=people, orders=[{"customer_id": 1, "total_amount": "10.25"},
                                                   {"customer_id": 6, "status": "cancelled"}])
    result = rows(customers.customer_geography(tables))
    assert [r["city"] for r in result] == ["Lima", "Cusco"]
    assert result[0]["order_count"] == 1 and result[0]["revenue_per_customer"] == 2.05
    assert result[1]["total_revenue"] is None and result[1]["order_count"] == 0
    assert len(rows(customers.customer_geography(tables, min_customers=4))) == 3


def test_ties_round_half_up(spark):
    people = [{}] * 14
    tables = shop(spark, customers=people, orders=[{"total_amount": "20908509.65"}])
    (row,) = rows(customers.customer_geography(tables))
    assert row["revenue_per_customer"] == 1493464.98


def test_products_of_one_name_add_up(spark):
    tables = shop(
        spark,
        products=[{}, {}, {"product_name": "Other"}],
        orders=[{"status": "cancelled"}],
        order_items=[{"subtotal": 5}, {"product_id": 2, "subtotal": 6},
                     {"product_id": 3, "subtotal": 10}],
    )
    assert [tuple(r.values()) for r in rows(products.top_products(tables))] == [
        ("Thing", 11.0),
        ("Other", 10.0),
    ]
    assert len(rows(products.top_products(tables, top_n=1))) == 1


def test_tiers_count_cancelled_orders(spark):
    tables = shop(spark, customers=[{}], orders=[{"total_amount": 1}, {"status": "cancelled"}])
    assert rows(customers.tier_summary(tables)) == [
        {"customer_tier": "standard", "count": 2, "avg_order_value": 50.5}
    ]


def test_seasonality_counts_weekdays(spark):
    tables = shop(spark, orders=_orders_on([0, 0, 7, 8]))  # 2023-01-01 is a Sunday
    result = by(trends.order_seasonality(tables), "weekday")
    assert result[6]["order_count"] == 3 and result[6]["days"] == 2
    assert result[6]["orders_per_day"] == 1.5 and result[6]["is_weekend"]
    assert not result[0]["is_weekend"]


def test_distinct_counts_agree_when_keys_are_not_trusted(spark):
    from tillmetrics.sources.star_files import star_tables

    tables = star_tables(spark, "/root/testdata/sf0.001")
    for report in (
        customers.customer_ltv_segments,
        customers.customer_geography,
        cohorts.cohort_activity,
        trends.daily_trends,
        products.sales_by_category_tier,
    ):
        trusting = sorted(report(tables).collect(), key=repr)
        assert trusting == sorted(report(tables, unique_keys=False).collect(), key=repr)


def test_repeated_order_ids_count_once_when_keys_are_not_trusted(spark):
    tables = shop(spark, customers=[{}], orders=[{"order_id": 1}, {"order_id": 1}])
    assert rows(customers.customer_ltv(tables, unique_keys=False))[0]["total_orders"] == 1


def test_invariants_over_the_files(spark):
    from tillmetrics.sources.star_files import star_tables

    tables = star_tables(spark, "/root/testdata/sf0.001")
    segments = rows(customers.customer_ltv_segments(tables))
    buyers = tables["orders"].filter("status <> 'cancelled'").select("customer_id").distinct()
    assert sum(s["customer_count"] for s in segments) == buyers.count()
    for r in rows(cohorts.cohort_retention(tables, "1995-01")):
        if r["cohort_month"] == r["activity_month"]:
            assert r["retention_rate_percent"] == 100.0
    paired = rows(kpi.kpi_dashboard(tables, dt.date(2001, 8, 1)))[0]
    own = rows(kpi.kpi_dashboard(tables, dt.date(2001, 8, 1), CORRECTED))[0]
    factor = tables["customers"].count() * tables["products"].count() * tables["payments"].count()
    assert paired["total_revenue"] == pytest.approx(own["total_revenue"] * factor)
    sold = (
        tables["order_items"]
        .join(tables["orders"].filter("status <> 'cancelled'"), "order_id")
        .agg({"subtotal": "sum"})
        .first()[0]
    )
    sales = rows(products.sales_by_category_tier(tables))
    assert sum(Decimal(str(r["total_revenue"])) for r in sales) == sold
