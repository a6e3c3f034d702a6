"""Each kind of dirt trips its own checks and no other."""

import datetime as dt
from collections import Counter

import pytest

from tests.shop import by, frame, rows, shop
from tillmetrics import load
from tillmetrics.quality import integrity, keys, profile, reconcile, stack
from tillmetrics.quality import rows as row_checks
from tillmetrics.schemas import CUSTOMERS, ORDERS, TABLES

# What is changed in one customer, product, order, line or payment, and the checks that must
# then count one violation more.
DIRT = [
    ("customers", {"email": None}, ["null email", "required email"]),
    ("customers", {"country": None}, ["required country"]),
    ("customers", {"email": "user1@example.com"}, ["unique email"]),
    ("customers", {"country": "x" * 101}, ["length country"]),
    ("customers", {"customer_tier": "x" * 21}, ["length customer_tier", "domain customer_tier"]),
    ("customers", {"customer_tier": "gold"}, ["domain customer_tier"]),
    ("products", {"cost_price": "7.01"}, ["cost_range cost_price"]),
    ("products", {"cost_price": "7.00"}, []),
    ("products", {"cost_price": "2.99"}, ["cost_range cost_price"]),
    ("products", {"stock_quantity": 500}, ["stock_range stock_quantity"]),
    ("products", {"stock_quantity": 49}, ["stock_range stock_quantity"]),
    ("products", {"category": "Toys", "stock_quantity": 99}, ["domain category"]),
    ("orders", {"order_date": None}, ["null order_date", "required order_date"]),
    ("orders", {"customer_id": 999}, ["reference customer_id"]),
    ("orders", {"status": "lost"}, ["domain status"]),
    ("order_items", {"quantity": 0, "subtotal": 0}, ["range quantity", "integrity_range quantity"]),
    ("order_items", {"order_item_id": 1}, ["unique order_item_id"]),
    ("order_items", {"order_id": 999}, ["reference order_id"]),
    ("order_items", {"product_id": 999}, ["reference product_id"]),
    ("order_items", {"subtotal": "10.01"}, ["exact_line_amount subtotal"]),
    ("order_items", {"subtotal": "10.02"}, ["exact_line_amount subtotal", "line_amount subtotal"]),
    ("order_items", {"unit_price": 5, "subtotal": 5}, ["discount_range unit_price"]),
    ("order_items", {"unit_price": 8, "subtotal": 8}, []),
    ("order_items", {"unit_price": -1, "subtotal": -1},
     ["integrity_range unit_price", "discount_range unit_price"]),
    ("payments", {"payment_id": 1}, ["unique payment_id"]),
    ("payments", {"transaction_id": "txn-1"}, ["unique transaction_id"]),
    ("payments", {"order_id": 999}, ["reference order_id"]),
    ("payments", {"payment_method": "cash"}, ["domain payment_method"]),
    ("payments", {"amount": 11}, ["order_amount amount"]),
    ("payments", {"payment_date": dt.datetime(2023, 3, 2, 12)}, ["payment_window payment_date"]),
    ("payments", {"payment_date": dt.datetime(2023, 3, 1, 12)}, ["payment_window payment_date"]),
    ("payments", {"payment_date": dt.datetime(2023, 3, 2, 11)}, []),
    ("payments", {"payment_status": "refunded"}, ["order_status payment_status"]),
    ("payments", {"payment_status": "failed"}, []),
    ("orders", {"status": "cancelled"}, ["order_status payment_status"]),
]


def clean(i):
    return {
        "customers": {},
        "products": {"price": 10, "cost_price": 5, "stock_quantity": 60},
        "orders": {"customer_id": i, "total_amount": 10},
        "order_items": {"order_id": i, "product_id": i},
        "payments": {"order_id": i, "amount": 10},
    }


def violations(tables):
    found = rows(
        stack(
            [
                row_checks.check_nulls(tables),
                row_checks.check_ranges(tables),
                row_checks.check_declared(tables),
                row_checks.check_domains(tables),
                row_checks.check_lines(tables),
                keys.check_unique(tables),
                keys.check_references(tables),
                reconcile.check_payments(tables),
                reconcile.check_pricing(tables),
            ]
        )
    )
    assert all(r["passed"] == (r["violations"] == 0) for r in found)
    return +Counter(
        {
            (r["table_name"], f"{r['check_name']} {r['column_name']}"): r["violations"]
            for r in found
        }
    )


def test_dirt_trips_its_checks_and_no_other(spark):
    data = {t: [] for t in clean(0)}
    expected = Counter()
    for i, (table, values, tripped) in enumerate([("orders", {}, []), *DIRT], 1):
        for name, row in clean(i).items():
            data[name].append({**row, **values} if name == table else row)
        for check in tripped:
            found_in = "payments" if check.startswith("order_status") else table
            expected[(found_in, check)] += 1
    assert violations(shop(spark, **data)) == expected


def test_repeated_parents_trip_uniqueness(spark):
    data = {t: [row] for t, row in clean(1).items()}
    for table in ("customers", "products", "orders"):
        data[table].append({**data[table][0], f"{table[:-1]}_id": 1})
    found = violations(shop(spark, **data))
    assert {k: found[k] for k in found if k[1].startswith("unique")} == {
        ("customers", "unique customer_id"): 1,
        ("products", "unique product_id"): 1,
        ("orders", "unique order_id"): 1,
    }


def test_price_bounds_differ_for_loading_and_integrity(spark):
    for price, load, integrity in ((-1, 1, 1), (0, 0, 1), (1, 0, 0)):
        products = frame(spark, "products", [{"price": price}])
        rules = row_checks.load_ranges(products) + row_checks.integrity_ranges(products)
        found = by(row_checks.count_violations(products, "products", rules), "check_name")
        assert found["range"]["violations"] == load
        assert found["integrity_range"]["violations"] == integrity


def test_null_quantity_is_no_range_violation(spark):
    items = frame(spark, "order_items", [{"quantity": None}])
    (row,) = rows(
        row_checks.count_violations(items, "order_items", row_checks.load_ranges(items))
    )
    assert row["passed"]


def test_empty_tables_pass(spark):
    tables = shop(spark)
    assert all(r["passed"] for r in rows(row_checks.check_nulls(tables)))
    assert all(r["passed"] for r in rows(keys.check_unique(tables)))
    assert all(r["passed"] for r in rows(keys.check_references(tables)))


def test_null_keys_neither_repeat_nor_refer(spark):
    tables = shop(spark, customers=[{"email": None}, {"email": None}],
                  orders=[{"customer_id": None}])
    assert all(r["passed"] for r in rows(keys.check_unique(tables)))
    assert all(r["passed"] for r in rows(keys.check_references(tables)))


def test_violating_rows_name_their_rules(spark):
    orders = frame(spark, "orders", [{}, {"total_amount": None, "customer_id": None}])
    bad = row_checks.violating_rows(orders, row_checks.critical_nulls(ORDERS))
    assert [(r["order_id"], r["violated_rules"]) for r in rows(bad)] == [
        (2, ["null:customer_id", "null:total_amount"])
    ]


def test_orders_are_reconciled_within_a_cent_per_line(spark):
    tables = shop(
        spark,
        orders=[{"total_amount": "20.02"}, {"total_amount": "10.02"}, {"total_amount": 5}],
        order_items=[{}, {}, {"order_id": 2}],
    )
    orders = by(reconcile.order_reconciliation(tables), "order_id")
    assert {k: v["verdict"] for k, v in orders.items()} == {1: "match", 2: "mismatch", 3: "no_items"}


def test_item_totals_replace_order_totals(spark):
    tables = shop(spark, orders=[{"total_amount": 1}, {"total_amount": 1}], order_items=[{}, {}])
    totals = by(reconcile.orders_with_item_totals(tables), "order_id")
    assert totals[1]["total_amount"] == 20.0 and totals[2]["total_amount"] == 0.0


def test_stock_and_price_ranges_depend_on_category_and_price(spark):
    products = frame(
        spark,
        "products",
        [
            {"category": "Electronics", "price": 101, "stock_quantity": 50},
            {"category": "Electronics", "price": 100, "stock_quantity": 50},
            {"category": "Clothing", "stock_quantity": 199},
            {"category": "Toys", "stock_quantity": 100},
            {"category": "Books", "price": "350.01", "stock_quantity": 50},
            {"category": "Electronics", "price": 600, "stock_quantity": 5},
        ],
    )
    rules = [r for r in reconcile.product_rules() if r.check != "cost_range"]
    bad = by(row_checks.violating_rows(products, rules), "product_id")
    assert {k: v["violated_rules"] for k, v in bad.items()} == {
        1: ["stock_range:stock_quantity"],
        4: ["stock_range:stock_quantity"],
        5: ["price_range:price"],
    }


def test_integrity_raises_with_every_finding(spark):
    tables = shop(spark, **{t: [{}] for t in TABLES})
    integrity.require_integrity(tables)
    tables = shop(spark, customers=[{}], products=[{"price": 0}], orders=[{}],
                  order_items=[{}, {"order_id": 7}], payments=[{}])
    with pytest.raises(
        ValueError,
        match="order_items.order_id reference: 1; products.price integrity_range: 1",
    ):
        integrity.require_integrity(tables)


def test_validation_result_has_verdict_issues_and_summary(spark):
    customers = frame(spark, "customers", [{"email": None}, {"city": None}, {}])
    (result,) = rows(load.validation_result(customers, CUSTOMERS))
    assert result["is_valid"] is False
    assert result["issues"] == ["null(email)=1", "required(city)=1", "required(email)=1"]
    assert result["summary"]["total_rows"] == 3 and result["summary"]["total_columns"] == 10
    assert result["summary"]["null_count"]["city"] == 1
    (result,) = rows(load.validation_result(frame(spark, "customers", [{}]), CUSTOMERS))
    assert result["is_valid"] is True and result["issues"] == []


def test_profile_counts_rows_columns_and_nulls(spark):
    customers = frame(spark, "customers", [{"city": None}, {}])
    described = by(profile.profile(customers, "customers"), "column_name")
    assert described["city"]["null_count"] == 1 and described["email"]["null_count"] == 0
    assert described["city"]["total_rows"] == 2 and described["city"]["total_columns"] == 10


def test_schema_document_lists_every_column(spark):
    document = rows(profile.schema_document(shop(spark, orders=[{}])))
    assert len(document) == 10 + 10 + 7 + 6 + 8
    (order_date,) = [r for r in document if r["column_name"] == "order_date"]
    assert order_date["data_type"] == "timestamp_ntz" and order_date["row_count"] == 1
