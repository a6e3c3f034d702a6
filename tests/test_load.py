"""Reading, validating, storing and reporting."""

import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest

from tests.shop import by, frame, rows, shop
from tillmetrics import load, session, sql
from tillmetrics.plans import trends
from tillmetrics.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, TABLES
from tillmetrics.sources import csv_files, parquet_files


def write(folder, name, text):
    Path(folder, f"{name}.csv").write_text(text)


CUSTOMER_CSV = '''customer_id,first_name,last_name,email,signup_date,customer_tier,country,city,loyalty_score,is_active,extra
1,Ann,Lee,a@x.org,2023-01-05,standard,"Korea, South","Say ""hi""",12.5,True,zzz
2,Bob,Ray,b@x.org,2023-01-06,premium,Peru,Lima,-1.5,False,zzz
'''


def test_csv_types_quotes_and_extra_columns(spark, tmp_path):
    write(tmp_path, "customers", CUSTOMER_CSV)
    found = by(csv_files.csv_tables(spark, str(tmp_path))["customers"], "customer_id")
    assert found[1]["country"] == "Korea, South" and found[1]["city"] == 'Say "hi"'
    assert found[1]["signup_date"] == dt.date(2023, 1, 5) and found[1]["is_active"] is True
    assert found[2]["loyalty_score"] == -1.5 and found[2]["is_active"] is False
    assert "extra" not in found[1]


def test_csv_columns_are_matched_by_name_and_missing_ones_are_null(spark, tmp_path):
    write(tmp_path, "order_items", "quantity,order_id,order_item_id\n2.0,7,1\n,8,2\nNaN,9,3\n")
    found = by(csv_files.read_csv(spark, f"{tmp_path}/order_items.csv", ORDER_ITEMS), "order_id")
    assert found[7]["quantity"] == 2 and found[7]["subtotal"] is None
    assert found[8]["quantity"] is None and found[9]["quantity"] is None


def test_malformed_fields_are_null_and_counted(spark, tmp_path):
    write(tmp_path, "products", "product_id,price,creation_date\n1,cheap,yesterday\n2,1.5,\n")
    df = csv_files.read_csv(spark, f"{tmp_path}/products.csv", PRODUCTS, keep_malformed=True)
    found = by(df, "product_id")
    assert found[1]["price"] is None and found[1][csv_files.MALFORMED] == 2
    assert found[2]["price"] == Decimal("1.50") and found[2][csv_files.MALFORMED] == 0


def test_csv_round_trip_keeps_every_value(spark, tmp_path):
    customers = frame(
        spark, "customers", [{"city": 'a "b", c', "country": None, "is_active": None}, {}]
    )
    orders = frame(spark, "orders", [{"order_date": dt.datetime(2023, 5, 6, 7, 8, 9, 250000)}])
    for table, df in ((CUSTOMERS, customers), (ORDERS, orders)):
        path = f"{tmp_path}/{table.name}.csv"
        csv_files.write_csv(df, path)
        assert sorted(rows(csv_files.read_csv(spark, path, table)), key=str) == sorted(
            rows(df), key=str
        )
    text = "".join(p.read_text() for p in Path(tmp_path, "customers.csv").glob("part-*"))
    assert text.startswith("customer_id,first_name") and ",True" in text


def small_shop(spark, **changes):
    data = {
        "customers": [{}],
        "products": [{}],
        "orders": [{}, {"order_date": dt.datetime(2023, 4, 2)}],
        "order_items": [{}],
        "payments": [{}],
    }
    return shop(spark, **{**data, **changes})


def test_load_stores_all_tables(spark, tmp_path):
    root = str(tmp_path / "db")
    statuses = load.load_tables(small_shop(spark), root)
    assert [(s.table_name, s.ok) for s in statuses] == [(t, True) for t in TABLES]
    assert [s.row_count for s in statuses] == [1, 1, 2, 1, 1]
    stored = parquet_files.stored_tables(spark, root)
    assert len(stored) == 5 and rows(stored["customers"])[0]["email"] == "user1@example.com"
    assert {p.name for p in Path(root, "orders").glob("data/*/order_month=*")} == {
        "order_month=2023-03",
        "order_month=2023-04",
    }
    load.require_all(statuses)


def test_loading_again_replaces(spark, tmp_path):
    root = str(tmp_path / "db")
    for _ in range(2):
        load.load_tables(small_shop(spark), root)
    assert parquet_files.stored_tables(spark, root)["orders"].count() == 2


@pytest.mark.parametrize(
    "table, data, reason",
    [
        ("order_items", [{"quantity": 0}], "range(quantity)=1"),
        ("products", [{"price": -1}], "range(price)=1"),
        ("customers", [{"city": None}], "required(city)=1"),
        ("orders", [{"order_date": None}], "null(order_date)=1, required(order_date)=1"),
        ("customers", [{}, {"email": "user1@example.com"}], "unique(email)=1"),
        ("payments", [{}, {"payment_id": 1}], "unique(payment_id)=1"),
    ],
)
def test_a_failed_check_keeps_its_table_out(spark, tmp_path, table, data, reason):
    root = str(tmp_path / "db")
    statuses = load.load_tables(small_shop(spark, **{table: data}), root)
    assert {s.table_name: s.ok for s in statuses} == {t: t != table for t in TABLES}
    assert next(s.reason for s in statuses if not s.ok) == reason
    assert not parquet_files.is_stored(spark, root, TABLES[table])
    with pytest.raises(RuntimeError, match=table):
        load.require_all(statuses)


def test_replacing_drops_months_that_are_gone(spark, tmp_path):
    root = str(tmp_path / "db")
    load.load_tables(small_shop(spark), root)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        load.load_tables(small_shop(spark, orders=[{}]), root, names=["orders"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["order_month"] for r in rows(parquet_files.read_table(spark, root, ORDERS))] == [
        "2023-03"
    ]


def test_a_failed_replacement_keeps_the_stored_rows(spark, tmp_path):
    root = str(tmp_path / "db")
    load.load_tables(small_shop(spark), root)
    load.load_tables(small_shop(spark, products=[{"price": -5}]), root)
    assert rows(parquet_files.stored_tables(spark, root)["products"])[0]["price"] == 10


def test_append_adds_rows_and_refuses_stored_keys(spark, tmp_path):
    root = str(tmp_path / "db")
    first = frame(spark, "customers", [{}])
    assert load.load_table(first, CUSTOMERS, root, load.APPEND).ok
    again = load.load_table(first, CUSTOMERS, root, load.APPEND)
    assert again.reason == "unique(customer_id)=1, unique(email)=1"
    more = frame(spark, "customers", [{"customer_id": 2, "email": "new@x.org"}])
    assert load.load_table(more, CUSTOMERS, root, load.APPEND).ok
    assert parquet_files.read_table(spark, root, CUSTOMERS).count() == 2


def test_not_a_number_is_stored_as_null_or_refused(spark, tmp_path):
    customers = frame(spark, "customers", [{"loyalty_score": float("nan")}])
    parquet_files.write_table(customers, str(tmp_path), CUSTOMERS)
    stored = parquet_files.read_table(spark, str(tmp_path), CUSTOMERS)
    assert rows(stored)[0]["loyalty_score"] is None


def test_csv_folder_with_missing_malformed_and_unknown_tables(spark, tmp_path):
    write(tmp_path, "customers", CUSTOMER_CSV)
    write(
        tmp_path,
        "products",
        "product_id,product_name,category,subcategory,price,cost_price,stock_quantity,supplier,"
        "creation_date,is_active\n1,Pen,Books,x,2.5,1.0,many,Acme,2023-01-01,True\n",
    )
    root = str(tmp_path / "db")
    statuses = load.load_csv_folder(spark, str(tmp_path), root)
    found = {s.table_name: s for s in statuses}
    assert found["customers"].ok
    assert "malformed(*)=1" in found["products"].reason
    assert found["orders"].reason == "missing file"
    unknown = load.load_tables({}, root, names=["returns"])
    assert unknown == [load.LoadStatus("returns", False, None, "unknown table")]

    report_path = str(tmp_path / "report")
    load.write_report(spark, statuses, root, report_path)
    (part,) = Path(report_path).glob("part-*.json")
    report = json.loads(part.read_text())
    assert report["success_rate"] == "20.0%"
    assert report["tables"]["customers"] is True and report["tables"]["orders"] is False
    assert report["summary"] == "Loaded 1 of 5 tables" and report["target"] == root
    frame_rows = by(load.status_frame(spark, statuses), "table_name")
    assert frame_rows["customers"]["success_rate"] == "20.0%"


def test_month_folders_are_pruned(spark, tmp_path):
    root = str(tmp_path / "db")
    orders = [{"order_date": dt.datetime(2023, m, 1 + d)} for m in (1, 2, 3) for d in range(28)]
    load.load_tables(small_shop(spark, orders=orders), root)
    tables = parquet_files.stored_tables(spark, root)
    report = trends.daily_trends(tables, days=10)
    result = report.collect()
    assert len(result) == 10 and result[0].order_day == dt.date(2023, 3, 28)
    plan = report._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "total_amount" in line and "FileScan" in line)
    assert "PartitionFilters: [(" in scan and "order_month" in scan.split("PartitionFilters")[1]


def test_stored_scans_push_filters_and_read_few_columns(spark, tmp_path):
    from tillmetrics.plans import customers

    root = str(tmp_path / "db")
    load.load_tables(small_shop(spark), root)
    report = customers.customer_ltv_segments(parquet_files.stored_tables(spark, root))
    plan = report._jdf.queryExecution().executedPlan().toString()
    orders = next(l for l in plan.splitlines() if "FileScan" in l and "total_amount" in l)
    assert "Not(EqualTo(status,cancelled))" in orders
    assert "shipping_city" not in orders
    people = next(l for l in plan.splitlines() if "FileScan" in l and "total_amount" not in l)
    assert "ReadSchema: struct<customer_id:bigint>" in people


def test_catalog_tables(spark, tmp_path):
    root = str(tmp_path / "db")
    load.load_tables(small_shop(spark), root)
    spark.sql("CREATE DATABASE IF NOT EXISTS till_test")
    parquet_files.create_tables(spark, root, "till_test")
    parquet_files.create_tables(spark, root, "till_test")  # exists already
    assert spark.table("till_test.orders").count() == 2
    assert spark.table("till_test.customers").first().city == "Lima"
    spark.sql("DROP DATABASE till_test CASCADE")


def test_sql_text_over_tables_and_views(spark):
    tables = small_shop(spark)
    count = sql.run_sql(spark, "SELECT count(*) AS n FROM {orders} WHERE status <> 'x'", tables)
    assert rows(count) == [{"n": 2}]
    sql.create_views(tables)
    sql.create_functions(spark)
    result = spark.sql("""
        SELECT strftime('%Y-%m', order_date) AS month, count(*) AS n,
               julianday(max(order_date)) - julianday(min(order_date)) AS days
        FROM orders GROUP BY 1 ORDER BY 1""")
    assert rows(result) == [
        {"month": "2023-03", "n": 1, "days": 0.0},
        {"month": "2023-04", "n": 1, "days": 0.0},
    ]
    (span,) = rows(spark.sql("SELECT julianday(TIMESTAMP_NTZ'2000-01-01 12:00:00') AS j"))
    assert span["j"] == 2451545.0


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_folder(spark, "x")
    assert folder != session.shared_folder(spark, "x")
    if base:
        assert folder.startswith(base)


def test_shuffle_partitions_follow_the_bytes():
    assert session.shuffle_partitions(1) == 8
    assert session.shuffle_partitions(10 * 1024**4) == 40960


def test_a_corrupt_table_does_not_stop_the_others(spark, tmp_path):
    tables = dict(small_shop(spark))
    folder = tmp_path / "broken"
    folder.mkdir()
    (folder / "part-0.parquet").write_bytes(b"PAR1 this is no table PAR1")
    tables["products"] = spark.read.schema(tables["products"].schema).parquet(str(folder))
    statuses = {s.table_name: s for s in load.load_tables(tables, str(tmp_path / "db"))}
    assert not statuses["products"].ok and statuses["products"].reason
    assert all(s.ok for n, s in statuses.items() if n != "products")


def test_profile_of_a_stored_table_has_its_declared_columns(spark, tmp_path):
    from tillmetrics.quality.profile import profile

    root = str(tmp_path / "db")
    load.load_tables(small_shop(spark), root)
    described = rows(profile(parquet_files.read_table(spark, root, ORDERS), "orders"))
    assert {r["column_name"] for r in described} == set(ORDERS.columns)
    assert {r["total_columns"] for r in described} == {len(ORDERS.columns)}


def test_money_beyond_two_places_is_malformed(spark, tmp_path):
    from tillmetrics.schemas import TABLES
    from tillmetrics.sources import csv_files

    table = TABLES["order_items"]
    money = [f.name for f in table.schema.fields if f.dataType.typeName() == "decimal"][0]
    (tmp_path / "x.csv").write_text(f"{money}\n1.239\n1.230\n2\n")
    read = csv_files.read_csv(spark, str(tmp_path / "x.csv"), table, keep_malformed=True)
    found = [(r[money], r[csv_files.MALFORMED]) for r in read.select(money, csv_files.MALFORMED).collect()]
    assert [(None if v is None else float(v), m) for v, m in found] == [(None, 1), (1.23, 0), (2.0, 0)]


ITEMS = "order_item_id,order_id,product_id,quantity,unit_price,subtotal\n"


def items_status(spark, tmp_path, **options):
    statuses = load.load_csv_folder(spark, str(tmp_path), str(tmp_path / "db"), **options)
    return next(s for s in statuses if s.table_name == "order_items")


def test_rows_with_surplus_or_missing_fields_are_refused(spark, tmp_path):
    write(tmp_path, "order_items", ITEMS + "1,1,1,1,2.5,2.5\n2,1,1,1,2.5,2.5,9,9\n3,1,1,1\n")
    assert "malformed(*)=2" in items_status(spark, tmp_path).reason


def test_parts_with_differing_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "order_items.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text(ITEMS + "1,7,1,1,2.5,2.5\n")
    swapped = ITEMS.replace("order_item_id,order_id", "order_id,order_item_id")
    (folder / "part-1.csv").write_text(swapped + "8,2,1,1,2.5,2.5\n")
    status = items_status(spark, tmp_path)
    assert not status.ok and "header" in status.reason.lower()


def test_line_breaks_inside_quotes_load_where_asked_for(spark, tmp_path):
    write(tmp_path, "customers", CUSTOMER_CSV.replace("Lima", '"Li\nma"'))
    root = str(tmp_path / "db")
    assert not load.load_csv_folder(spark, str(tmp_path), root)[0].ok
    assert load.load_csv_folder(spark, str(tmp_path), root, multi_line=True)[0].ok
    found = by(parquet_files.read_table(spark, root, CUSTOMERS), "customer_id")
    assert found[2]["city"] == "Li\nma"


def test_an_unnamed_or_empty_csv_still_reads(spark, tmp_path):
    write(tmp_path, "a", "," + ITEMS + "0,1,7,1,1,2.5,2.5\n")
    found = rows(csv_files.read_csv(spark, f"{tmp_path}/a.csv", ORDER_ITEMS, keep_malformed=True))
    assert found[0]["order_id"] == 7 and found[0][csv_files.MALFORMED] == 0
    write(tmp_path, "b", "")
    assert rows(csv_files.read_csv(spark, f"{tmp_path}/b.csv", ORDER_ITEMS, True)) == []


def test_a_write_that_fails_in_a_task_keeps_the_stored_rows(spark, tmp_path):
    root = str(tmp_path / "db")
    load.load_tables(small_shop(spark), root)
    ancient = frame(spark, "customers", [{"signup_date": dt.date(1500, 1, 1)}])
    spark.conf.set("spark.sql.parquet.datetimeRebaseModeInWrite", "EXCEPTION")
    try:
        (status,) = load.load_tables({"customers": ancient}, root, names=["customers"])
    finally:
        spark.conf.unset("spark.sql.parquet.datetimeRebaseModeInWrite")
    assert not status.ok and status.reason
    stored = rows(parquet_files.read_table(spark, root, CUSTOMERS))
    assert [r["signup_date"] for r in stored] == [dt.date(2023, 1, 1)]
    assert {p.name for p in Path(root).iterdir()} == set(TABLES)


def test_staged_rows_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "shared_folder", lambda _, purpose: str(tmp_path / purpose))
    write(tmp_path, "customers", CUSTOMER_CSV)
    assert load.load_csv_folder(spark, str(tmp_path), str(tmp_path / "db"))[0].ok
    assert not (tmp_path / "staging").exists()
