"""States of stored orders kept per part, and tables in buckets of the order id."""

import random
from pathlib import Path

import pytest

from tests.shop import rows, shop
from tests.test_random import random_shop
from tillmetrics import load
from tillmetrics.operators.rollups import live, orders_by_customer
from tillmetrics.plans import CORRECTED, cohorts, customers, trends
from tillmetrics.quality import reconcile
from tillmetrics.schemas import ORDERS, PAYMENTS
from tillmetrics.sources import bucketed, parquet_files, snapshots, states


@pytest.fixture
def stored(spark, tmp_path):
    """Random orders stored in three parts; the tables as well."""
    tables = dict(random_shop(spark, 11, n_orders=400))
    tables["orders"] = tables["orders"].dropna(subset=ORDERS.required).cache()
    root = str(tmp_path / "db")
    for i in range(3):
        mode = load.APPEND if i else load.REPLACE
        assert load.load_table(tables["orders"].filter(f"order_id % 3 = {i}"), ORDERS, root, mode).ok
    yield root, tables
    tables["orders"].unpersist()


def same(a, b):
    assert a.columns == b.columns
    assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)


def test_reports_from_states_equal_a_full_run(spark, stored):
    root, tables = stored
    same(states.customers_orders(spark, root), orders_by_customer(live(tables["orders"])))
    ltv = customers.ltv_of(states.customers_orders(spark, root), tables["customers"])
    same(ltv, customers.customer_ltv(tables))
    found = cohorts.cohort_activity_of(states.customer_months(spark, root), tables["customers"])
    same(found, cohorts.cohort_activity(tables))


@pytest.mark.parametrize("chars", [4, 7])
def test_distinct_buyers_are_exact_and_sketches_near(spark, stored, chars):
    root, tables = stored
    tables["orders"].createOrReplaceTempView("all_orders")
    exact = spark.sql(
        f"SELECT substr(date_format(order_date, 'yyyy-MM'), 1, {chars}) AS span, count(DISTINCT customer_id) AS buyers "
        "FROM all_orders WHERE status <> 'cancelled' GROUP BY 1"
    )
    same(states.distinct_buyers(spark, root, chars), exact)
    wanted = {r["span"]: r["buyers"] for r in exact.collect()}
    for r in states.estimated_buyers(spark, root, chars).collect():
        assert abs(r["buyers"] - wanted[r["span"]]) <= 1 + 0.05 * wanted[r["span"]]


def test_distinct_buyers_of_any_ids(spark, tmp_path):
    r = random.Random(3)
    ids = [r.choice([-5, -32768, 0, 1, 32768, 32769, 2**40, 2**62]) for _ in range(60)]
    orders = shop(spark, orders=[{"customer_id": i} for i in ids])["orders"]
    root = str(tmp_path)
    assert load.load_table(orders, ORDERS, root).ok
    assert rows(states.distinct_buyers(spark, root)) == [{"span": "2023-03", "buyers": len(set(ids))}]


def test_an_append_reads_only_new_rows(spark, stored, monkeypatch):
    root, tables = stored
    assert len(states.refresh(spark, root, "customer_months")) == 3
    assert states.refresh(spark, root, "customer_months") == []
    more = tables["orders"].selectExpr("order_id + 1000000 AS order_id", *ORDERS.columns[1:])
    assert load.load_table(more, ORDERS, root, load.APPEND).ok
    new = parquet_files.version(spark, root, ORDERS).parts[-1]
    read, seen = parquet_files.read_part, []
    monkeypatch.setattr(parquet_files, "read_part", lambda s, r, t, part: seen.append(part) or read(s, r, t, part))
    assert states.refresh(spark, root, "customer_months") == [new] and seen == [new]


@pytest.fixture
def paid(spark, stored):
    """Payments stored in two parts beside the orders; some are of orders that are not there."""
    root, tables = stored
    payments = tables["payments"].dropna(subset=list(PAYMENTS.required)).dropDuplicates(["transaction_id"]).cache()
    for i in range(2):
        mode = load.APPEND if i else load.REPLACE
        assert load.load_table(payments.filter(f"payment_id % 2 = {i}"), PAYMENTS, root, mode).ok
    yield root, {**tables, "payments": payments}
    payments.unpersist()


def test_daily_trends_from_states_equal_a_full_run(spark, paid):
    root, tables = paid
    full = trends.daily_metrics(live(tables["orders"]), tables["payments"], CORRECTED)
    same(states.daily_figures(spark, root), full)
    for days in (3, 30):
        found = trends.trends_of(states.daily_figures(spark, root, days + trends.WEEK), CORRECTED, days)
        same(found, trends.daily_trends(tables, CORRECTED, days))


def test_appended_payments_meet_all_orders_and_the_reverse(spark, paid, monkeypatch):
    root, tables = paid
    assert len(states.refresh_day_payments(spark, root)) == 6
    assert states.refresh_day_payments(spark, root) == []
    more = tables["payments"].selectExpr(
        *[f"payment_id + 1000000 AS {c}" if c == "payment_id" else f"concat({c}, 'x') AS {c}" if c == "transaction_id" else c
          for c in PAYMENTS.columns]
    )
    assert load.load_table(more, PAYMENTS, root, load.APPEND).ok
    new = parquet_files.version(spark, root, PAYMENTS).parts[-1]
    read, seen = parquet_files.read_part, []
    monkeypatch.setattr(parquet_files, "read_part", lambda s, r, t, part: seen.append((t.name, part)) or read(s, r, t, part))
    assert [p for p, _ in states.refresh_day_payments(spark, root)] == [new] * 3
    assert [part for name, part in seen if name == "payments"] == [new]
    orders = shop(spark, orders=[{"order_id": 9_000_000 + i, "customer_id": 1} for i in range(3)])["orders"]
    assert load.load_table(orders, ORDERS, root, load.APPEND).ok
    all_orders = tables["orders"].select(*ORDERS.columns).union(orders.select(*ORDERS.columns))
    full = trends.daily_metrics(live(all_orders), tables["payments"].select(*PAYMENTS.columns).union(more), CORRECTED)
    same(states.daily_figures(spark, root), full)


def test_daily_figures_without_payments(spark, stored):
    root, _ = stored
    with pytest.raises(FileNotFoundError):
        states.daily_figures(spark, root)
    nothing = shop(spark, payments=[{}])["payments"].limit(0)
    assert load.load_table(nothing, PAYMENTS, root).ok
    assert {r["failed_payments"] for r in states.daily_figures(spark, root).collect()} == {0}


def test_a_state_half_written_is_made_anew_and_a_replaced_one_removed(spark, stored):
    root, tables = stored
    first = states.refresh(spark, root, "customer_months")[0]
    folder = Path(root, "orders", snapshots.beside(first, "state_customer_months"))
    Path(folder, "_SUCCESS").unlink()
    next(folder.glob("part-*.parquet")).unlink()
    assert states.refresh(spark, root, "customer_months") == [first]
    same(states.customers_orders(spark, root), orders_by_customer(live(tables["orders"])))
    some = tables["orders"].filter("order_id % 3 = 1")
    assert load.load_table(some, ORDERS, root).ok
    same(states.customers_orders(spark, root), orders_by_customer(live(some)))
    removed = snapshots.vacuum(spark, f"{root}/orders", hours=-1)
    assert sum(x.startswith("state_customer_months/") for x in removed) == 3
    same(states.customers_orders(spark, root), orders_by_customer(live(some)))


def test_nothing_stored(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        states.read(spark, str(tmp_path), "buyer_bitmaps")


@pytest.fixture
def buckets(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS till_buckets")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield str(tmp_path / "buckets")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP DATABASE till_buckets CASCADE")


def test_bucketed_tables_join_without_a_shuffle(spark, buckets):
    tables = random_shop(spark, 12, n_orders=200)
    assert bucketed.store(tables, buckets, "till_buckets", 4) == ["orders", "order_items", "payments"]
    found = bucketed.tables(spark, "till_buckets")
    joined = found["orders"].join(found["order_items"], "order_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == tables["orders"].join(tables["order_items"], "order_id").count()
    totals = reconcile.orders_with_item_totals(found)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    same(totals, reconcile.orders_with_item_totals({**tables, "order_items": tables["order_items"]}))
    assert len(list(Path(buckets, "orders").glob("part-*"))) <= 4


def test_a_table_with_a_hot_order_is_not_bucketed(spark, buckets):
    items = [{"order_id": 1}] * 30 + [{"order_id": i} for i in range(2, 30)]
    tables = shop(spark, orders=[{}] * 30, order_items=items, payments=[{}])
    assert bucketed.store(tables, buckets, "till_buckets", 4, hot_rows=20) == ["orders", "payments"]
    found = bucketed.tables(spark, "till_buckets")
    assert found["orders"].join(found["order_items"], "order_id").count() == 58
