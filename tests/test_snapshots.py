"""Publishing tables in versions, and checking appended keys against an index."""

import random
import threading
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.shop import frame, rows, shop
from tillmetrics import load
from tillmetrics.schemas import CUSTOMERS, ORDERS, PRODUCTS
from tillmetrics.sources import key_index, parquet_files, snapshots
from tillmetrics.sources.snapshots import KeyRange, Part


def prices(spark, root):
    return sorted({float(r["price"]) for r in rows(parquet_files.read_table(spark, root, PRODUCTS))})


def products(spark, price, n=40):
    return frame(spark, "products", [{"price": price}] * n)


def test_a_reader_sees_the_old_or_the_new_rows(spark, tmp_path):
    root = str(tmp_path)
    assert load.load_table(products(spark, 1), PRODUCTS, root).ok
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append([float(r["price"]) for r in rows(parquet_files.read_table(spark, root, PRODUCTS))])

    reader = threading.Thread(target=read)
    reader.start()
    for price in (2, 3, 4):
        assert load.load_table(products(spark, price), PRODUCTS, root).ok
    done.set()
    reader.join()
    assert seen and all(len(x) == 40 and len(set(x)) == 1 for x in seen)
    assert prices(spark, root) == [4.0]


def test_a_frame_read_before_a_replacement_keeps_its_rows(spark, tmp_path):
    root = str(tmp_path)
    load.load_table(products(spark, 1), PRODUCTS, root)
    before = parquet_files.read_table(spark, root, PRODUCTS)
    load.load_table(products(spark, 2), PRODUCTS, root)
    assert {float(r["price"]) for r in rows(before)} == {1.0}
    assert snapshots.vacuum(spark, f"{root}/products", hours=24) == []
    assert len(snapshots.vacuum(spark, f"{root}/products", hours=-1)) == 3  # rows, key index, ranges of files
    assert prices(spark, root) == [2.0]


@pytest.mark.parametrize("step", ["key_index.write", "key_index.ranges", "snapshots.publish", "parquet_files.read_part"])
def test_a_driver_lost_at_any_step_needs_no_mending(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    load.load_table(products(spark, 1), PRODUCTS, root)

    class Lost(BaseException):
        pass

    def lost(*args, **kwargs):
        raise Lost

    module, name = step.split(".")
    with monkeypatch.context() as m:
        m.setattr({"key_index": key_index, "snapshots": snapshots, "parquet_files": parquet_files}[module], name, lost)
        m.setattr(parquet_files, "discard_part", lambda *a: None)  # no time to tidy up
        with pytest.raises(Lost):
            load.load_table(products(spark, 2), PRODUCTS, root)
    assert prices(spark, root) == [1.0]
    assert load.load_table(products(spark, 3), PRODUCTS, root).ok and prices(spark, root) == [3.0]
    snapshots.vacuum(spark, f"{root}/products", hours=-1)
    assert prices(spark, root) == [3.0] and len(list(Path(root, "products", "data").iterdir())) == 1


def test_a_version_half_written_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    load.load_table(products(spark, 1), PRODUCTS, root)
    Path(root, "products", "versions", ".2.json.12.tmp").write_text('{"parts": [')
    assert prices(spark, root) == [1.0]
    assert load.load_table(products(spark, 2), PRODUCTS, root).ok and prices(spark, root) == [2.0]


def test_the_second_of_two_writers_from_one_version_is_refused(spark, tmp_path):
    folder = str(tmp_path / "t")
    base = snapshots.newest(spark, folder)
    first = snapshots.publish(spark, folder, base, (Part("data/a", 1),))
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, folder, base, (Part("data/b", 1),))
    assert snapshots.newest(spark, folder) == first
    both = (*first.parts, Part("data/c", 2, {"id": KeyRange(2, 1, 2, 1), "name": KeyRange(2, "a", "b", 1)}))
    assert snapshots.publish(spark, folder, first, both) == snapshots.newest(spark, folder)


def test_an_append_meets_the_keys_of_one_that_was_faster(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert load.load_table(frame(spark, "customers", [{}]), CUSTOMERS, root).ok
    publish, entered = parquet_files.publish_part, []

    def late(*args):
        if not entered:
            entered.append(1)
            other = frame(spark, "customers", [{"customer_id": 2, "email": "2@x"}])
            assert load.load_table(other, CUSTOMERS, root, load.APPEND).ok
        return publish(*args)

    monkeypatch.setattr(parquet_files, "publish_part", late)
    mine = frame(spark, "customers", [{"customer_id": 2, "email": "3@x"}])
    assert load.load_table(mine, CUSTOMERS, root, load.APPEND).reason == "unique(customer_id)=1"
    entered.clear()
    other = frame(spark, "customers", [{"customer_id": 4, "email": "4@x"}])
    monkeypatch.setattr(parquet_files, "publish_part", publish)
    assert load.load_table(other, CUSTOMERS, root, load.APPEND).ok
    assert sorted(r["customer_id"] for r in rows(parquet_files.read_table(spark, root, CUSTOMERS))) == [1, 2, 4]


def stored_orders(spark, root, ids, mode=load.REPLACE):
    df = spark.createDataFrame([(i,) for i in ids], "order_id bigint").selectExpr(
        "order_id", "1L AS customer_id", "TIMESTAMP_NTZ'2023-01-01' + make_interval(0, CAST(order_id % 5 AS int)) AS order_date",
        "'shipped' AS status", "'x' AS shipping_country", "'y' AS shipping_city", "CAST(1 AS decimal(18,2)) AS total_amount",
    )
    return load.load_table(df, ORDERS, root, mode)


@pytest.mark.parametrize("buckets", [None, 1])
def test_every_repeated_key_is_found(spark, tmp_path, monkeypatch, buckets):
    if buckets:  # full bitmaps: everything is suspect, and looked up
        monkeypatch.setattr(key_index, "BUCKET_BITS", 64)
        monkeypatch.setattr(key_index, "PORTION_BYTES", 16 * 300)  # several portions
    rng = random.Random(4)
    ids = rng.sample(range(20_000), 3000)
    root = str(tmp_path)
    assert stored_orders(spark, root, ids[:1500]).ok
    assert stored_orders(spark, root, ids[1500:2500], load.APPEND).ok
    assert len(snapshots.newest(spark, f"{root}/orders").parts) == 2
    again = rng.sample(ids[:2500], 700)
    assert stored_orders(spark, root, again + ids[2500:], load.APPEND).reason == "unique(order_id)=700"
    assert stored_orders(spark, root, ids[2500:], load.APPEND).ok
    assert sorted(r["order_id"] for r in rows(parquet_files.read_table(spark, root, ORDERS))) == sorted(ids)


@pytest.mark.parametrize("portions", [32, 0])
def test_absent_references_are_found(spark, tmp_path, monkeypatch, portions):
    monkeypatch.setattr(key_index, "PORTIONS", portions)  # none: by a join
    monkeypatch.setattr(key_index, "PORTION_BYTES", 16 * 200)
    root = str(tmp_path)
    stored_orders(spark, root, range(0, 3000, 3))
    stored_orders(spark, root, range(10_000, 10_050), load.APPEND)
    now = snapshots.newest(spark, f"{root}/orders")
    references = spark.createDataFrame([(i,) for i in [None, *range(900), 10_001, 10_001, 99_999, -4]], "key bigint")
    found = key_index.absent(ORDERS, f"{root}/orders", now, "order_id", references)
    assert sorted(r["key"] for r in found.collect()) == sorted([i for i in range(900) if i % 3] + [99_999, -4])
    nothing = key_index.absent(ORDERS, f"{root}/none", snapshots.EMPTY, "order_id", references)
    assert nothing.count() == 903


def test_few_new_keys_are_suspect(spark, tmp_path):
    root = str(tmp_path)
    stored_orders(spark, root, range(0, 40_000, 2))
    now = snapshots.newest(spark, f"{root}/orders")
    new = spark.range(1, 40_000, 2).withColumnRenamed("id", "key")
    found = key_index.suspects(spark, f"{root}/orders", list(now.parts), "order_id", new)
    assert found.count() < 200  # of 20 000
    old = spark.range(0, 40_000, 2).withColumnRenamed("id", "key")
    assert key_index.suspects(spark, f"{root}/orders", list(now.parts), "order_id", old).count() == 20_000


def test_parts_of_other_ranges_are_not_consulted(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    stored_orders(spark, root, range(100))

    def none(*args):
        raise AssertionError("the index was read")

    monkeypatch.setattr(key_index, "suspects", none)
    assert stored_orders(spark, root, range(100, 150), load.APPEND).ok
    with pytest.raises(AssertionError):
        stored_orders(spark, root, range(149, 160), load.APPEND)


def test_stored_keys_are_not_shuffled(spark, tmp_path):
    root = str(tmp_path)
    stored_orders(spark, root, range(1000))
    stored = parquet_files.read_table(spark, root, ORDERS).select(F.col("order_id").alias("key"))
    plan = key_index.looked_up(stored, spark.range(5).withColumnRenamed("id", "key"))
    lines = plan._jdf.queryExecution().sparkPlan().toString().splitlines()  # before adaptive stages hide it
    text = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(text) if "BroadcastHashJoin" in line and "LeftSemi" in line)
    scan = next(i for i, line in enumerate(text) if "FileScan" in line)
    between = [line for line in text[join:scan] if "Exchange" in line]
    assert lines and join < scan and not between


def test_row_checks_need_no_scan_of_their_own(spark, tmp_path, monkeypatch):
    """The part is written with its counts; before that nothing reads the table but the sampling of its order."""
    bad = frame(spark, "products", [{"price": -1}, {"price": None}, {"product_name": None}, {}])
    rules = {f"{r.check}({r.column})": r.violated for r in load.gate_rules(PRODUCTS, bad)}
    part, counts = parquet_files.write_part(bad, str(tmp_path), PRODUCTS, rules=rules)
    checked = {f"{r['check_name']}({r['column_name']})": r["violations"] for r in load.validate(bad, PRODUCTS).collect()}
    assert counts == {k: v for k, v in checked.items() if not k.startswith("unique")}
    assert part.rows == 4 and replace(part, folder="") == Part("", 4)


def test_views_follow_when_asked_to(spark, tmp_path):
    root = str(tmp_path / "db")
    load.load_tables(shop(spark, customers=[{}], products=[{"price": 5}]), root)
    spark.sql("CREATE DATABASE IF NOT EXISTS till_views")
    parquet_files.create_tables(spark, root, "till_views")
    assert spark.table("till_views.orders").count() == 0 and spark.table("till_views.orders").columns == ORDERS.columns
    load.load_table(products(spark, 7, 3), PRODUCTS, root)
    assert spark.table("till_views.products").count() == 1
    parquet_files.create_tables(spark, root, "till_views", refresh=True)
    assert spark.table("till_views.products").count() == 3
    spark.sql("DROP DATABASE till_views CASCADE")


def test_an_index_sorts_each_key_once(spark, tmp_path, monkeypatch):
    seen = []
    made = key_index.F.bitmap_construct_agg
    monkeypatch.setattr(key_index.F, "bitmap_construct_agg", lambda bit: seen.append(bit) or made(bit))
    rows = spark.range(5000).withColumnRenamed("id", "order_id")
    known = key_index.ranges(rows, ("order_id",))
    key_index.write(rows, known, f"{tmp_path}/index")
    assert len(seen) == key_index.BITS  # a bitmap per hash, not a row per bit
    index = spark.read.parquet(f"{tmp_path}/index/column=order_id")
    assert index.count() == known["order_id"].buckets
    probes = rows.select(key_index._bucket(key_index.F.col("order_id"), known["order_id"].buckets).alias("bucket"), "order_id")
    met = probes.join(index, "bucket")
    for bit in key_index._bits(key_index.F.col("order_id")):
        met = met.filter(key_index._is_set(key_index.F.col("bitmap"), bit))
    assert met.count() == 5000
