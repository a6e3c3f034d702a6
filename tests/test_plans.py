"""What the physical plans of all queries must and must not contain."""

import pytest

from tillmetrics import registry

FOLDER = "/root/testdata/sf0.001"
PLANNED = {
    **registry.REPORTS,
    **registry.OPERATORS,
    **registry.QUALITY,
    "sql_text": registry.FILES["sql_text"],
}


def plan_of(spark, name, final=False):
    df = PLANNED[name](spark, FOLDER)
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(params=[True, False], ids=["small", "large"])
def size(request, spark):
    """With broadcasts, as for small tables, and without any, as for large ones."""
    if not request.param:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_pairing_and_no_python(spark, size):
    for name in PLANNED:
        plan = plan_of(spark, name)
        for word in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "RDDScan"):
            assert word not in plan, f"{name}: {word}"


def test_scans_read_declared_columns_only(spark):
    scans = [l for l in plan_of(spark, "top_products").splitlines() if "FileScan" in l]
    assert any("ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in l for l in scans)
    assert any("ReadSchema: struct<p_partkey:bigint,p_name:string>" in l for l in scans)


@pytest.mark.parametrize("name", ["topk", "top_products", "product_performance", "daily_trends"])
def test_top_rows_are_not_sorted_in_full(spark, name):
    assert "TakeOrderedAndProject" in plan_of(spark, name)


@pytest.mark.parametrize("name", ["product_metrics", "product_performance"])
def test_items_are_shuffled_once(spark, name):
    plan = plan_of(spark, name, final=True)
    assert "ReusedExchange" in plan
    assert sum("FileScan" in l and "l_partkey" in l for l in plan.splitlines()) == 1


def test_windows_run_on_aggregated_rows(spark):
    """Below each window there is an aggregate; none of them sees a base table's rows."""
    for name in PLANNED:
        lines = plan_of(spark, name).splitlines()
        for i, line in enumerate(lines):
            if line.strip(" :+-*()0123456789").startswith("Window"):
                assert any("HashAggregate" in below for below in lines[i + 1 :]), name


def test_live_orders_are_limited_to_the_days_needed(spark):
    """The first day needed is a subquery in the filter right above the scan of the orders."""
    lines = plan_of(spark, "daily_trends").splitlines()
    at = next(i for i, l in enumerate(lines) if "Filter" in l and "Subquery" in l)
    join = next(i for i, l in enumerate(lines) if "Join" in l and "LeftOuter" in l)
    assert join < at and "o_orderdate" in lines[at] and "IS NULL" not in lines[at]


def test_rows_are_reduced_before_they_are_shuffled(spark):
    """Sales go through the network as one row per order and category and per customer."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(spark, "sales_by_category_tier").splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for keys in ("order_id", "customer_id"):
        at = next(
            i
            for i, l in enumerate(lines)
            if "Exchange hashpartitioning" in l and keys in l and "category" in l
        )
        assert "partial_" in lines[at + 1]


def _depth(line):
    return len(line) - len(line.lstrip(" :+-"))


def test_joined_rows_are_only_partially_aggregated_in_place(spark):
    """An aggregate that relied on a join's partitioning would keep Spark from splitting hot keys."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {name: plan_of(spark, name).splitlines() for name in PLANNED}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = set()
    for name, lines in plans.items():
        for i, line in enumerate(lines):
            if "SortMergeJoin" not in line:
                continue
            depth, merged = _depth(line), 0
            for above in reversed(lines[:i]):
                if _depth(above) >= depth:
                    continue
                depth = _depth(above)
                if "Exchange" in above:
                    break
                merged += "HashAggregate" in above and "partial_" not in above
            if merged:
                found.add(name)
    assert found == set()
