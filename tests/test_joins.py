"""Left joins with hot keys, and reports over tables whose keys repeat."""

import random

import pytest

from tests.shop import shop
from tillmetrics.operators import joins
from tillmetrics.plans import cohorts, customers, products


def sides(spark, seed, text=False):
    r = random.Random(seed)
    key = "string" if text else "bigint"

    def value(x):
        return f"k{x}" if text and x is not None else x

    left = [(value(r.choice([1, 1, 2, 3, 50, 51, None])), i) for i in range(60)]
    right = [(value(r.choice([1, 1, 1, 2, 3, 4, None])), i) for i in range(900)]
    return spark.createDataFrame(left, f"k {key}, a int"), spark.createDataFrame(right, f"k {key}, b int")


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
@pytest.mark.parametrize("text", [False, True])
def test_left_join_equals_the_plain_one(spark, hot_rows, text):
    left, right = sides(spark, 1, text)
    found = joins.left_join_split(left, right, "k", hot_rows)
    assert found.columns == ["k", "a", "b"]
    expected = left.join(right, "k", "left")
    assert sorted(found.collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_left_join_of_empty_sides(spark):
    left, right = sides(spark, 2)
    assert joins.left_join_split(left, right.limit(0), "k", 1).count() == 60
    assert joins.left_join_split(left.limit(0), right, "k", 1).count() == 0


def test_frequent_keys_are_counted(spark):
    df = spark.range(10_000).selectExpr("IF(id % 3 = 0, 7, id + 100000) AS k")
    assert joins.frequent_keys(df, "k", 1000) == {7: 3334}
    assert joins.frequent_keys(df.filter("k > 7"), "k", 1000) == {}


def test_each_side_is_scanned_once_and_only_hot_keys_are_dealt(spark, tmp_path):
    left, right = sides(spark, 3)
    left.write.parquet(f"{tmp_path}/left")
    right.write.parquet(f"{tmp_path}/right")
    left, right = spark.read.parquet(f"{tmp_path}/left"), spark.read.parquet(f"{tmp_path}/right")
    joined = joins.left_join_split(left, right, "k", 300)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == 2
    # Key 1 has over a third of the rows: no salt of it has more than hot_rows, nearly.
    from pyspark.sql import functions as F

    shares = joins.frequent_keys(right, "k", 300)
    assert set(shares) == {1}
    salted = right.withColumn("s", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(2))).filter("k = 1")
    assert max(r["count"] for r in salted.groupBy("s").count().collect()) < 300


@pytest.mark.parametrize(
    "report, name",
    [
        (customers.customer_ltv, "customers"),
        (customers.customer_geography, "customers"),
        (cohorts.cohort_activity, "customers"),
        (cohorts.customer_monthly_activity, "customers"),
        (products.sales_by_category_tier, "customers"),
        (products.sales_by_category_tier, "orders"),
        (products.sales_by_category_tier, "products"),
    ],
)
def test_a_repeated_parent_is_refused(spark, report, name):
    key = {"customers": "customer_id", "orders": "order_id", "products": "product_id"}[name]
    tables = {"customers": [{}], "products": [{}], "orders": [{}], "order_items": [{}], name: [{key: 1}, {key: 1}]}
    with pytest.raises(ValueError, match=f"{name}.{key} 1 is on 2 rows"):
        report(shop(spark, **tables), unique_keys=False)
