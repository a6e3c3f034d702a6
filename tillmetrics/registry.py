"""Every report, operator and check by name, over the star-schema files of a folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics import load, sql
from tillmetrics.operators import aggregates, joins, ordering, predicates, scalars, windows
from tillmetrics.plans import (
    CORRECTED,
    Tables,
    cohorts,
    customers,
    kpi,
    payments,
    products,
    trends,
)
from tillmetrics.quality import integrity, keys, profile, reconcile, rows, stack
from tillmetrics.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PAYMENTS, PRODUCTS, TABLES, Table
from tillmetrics.session import shared_folder
from tillmetrics.sources import TableSet, bucketed, csv_files, parquet_files, states
from tillmetrics.sources.star_files import star_tables

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2001, 8, 1)  # the day the key figures are taken at
MIN_COHORT = "1995-01"  # the files' orders start then


def _over(report: Callable[..., DataFrame], shipping: bool = False, **options) -> Query:
    return lambda spark, folder: report(star_tables(spark, folder, shipping), **options)


REPORTS: dict[str, Query] = {
    "customer_ltv": _over(customers.customer_ltv),
    "customer_ltv_segments": _over(customers.customer_ltv_segments),
    "product_metrics": _over(products.product_metrics),
    "product_metrics_corrected": _over(products.product_metrics, mode=CORRECTED),
    "product_performance": _over(products.product_performance),
    "product_performance_corrected": _over(products.product_performance, mode=CORRECTED),
    "daily_rolling": _over(trends.daily_rolling),
    "daily_rolling_corrected": _over(trends.daily_rolling, mode=CORRECTED),
    "daily_trends": _over(trends.daily_trends),
    "daily_trends_corrected": _over(trends.daily_trends, mode=CORRECTED),
    "order_seasonality": _over(trends.order_seasonality),
    "customer_monthly_activity": _over(cohorts.customer_monthly_activity),
    "cohort_activity": _over(cohorts.cohort_activity),
    "cohort_retention": _over(cohorts.cohort_retention, min_cohort=MIN_COHORT),
    "payment_method_status": _over(payments.payment_method_status),
    "payment_risk": _over(payments.payment_risk),
    "payment_risk_corrected": _over(payments.payment_risk, mode=CORRECTED),
    "kpi_dashboard": _over(kpi.kpi_dashboard, as_of=AS_OF),
    "kpi_dashboard_corrected": _over(kpi.kpi_dashboard, as_of=AS_OF, mode=CORRECTED),
    "sales_by_category_tier": _over(products.sales_by_category_tier),
    "customer_geography": _over(customers.customer_geography),
    "top_products": _over(products.top_products),
    "tier_summary": _over(customers.tier_summary),
}

OPERATORS: dict[str, Query] = {
    "filter_not_equal": _over(predicates.live_orders),
    "filter_month_text": _over(predicates.orders_since_month, month="1998-06"),
    "filter_recent_days": _over(predicates.orders_of_last_days, as_of=AS_OF, days=90),
    "filter_not_null": _over(predicates.identified_orders),
    "filter_compare": _over(predicates.risky_payments, threshold=0.5),
    "filter_equal": _over(predicates.failed_payments),
    "filter_flag_customers": _over(predicates.active_customers),
    "filter_flag_products": _over(predicates.active_products),
    "project_star_plus": _over(predicates.products_with_profit),
    "lookup_by_key": _over(predicates.items_at_catalogue_price),
    "join_inner": _over(joins.orders_of_customers),
    "join_star": _over(joins.order_lines),
    "join_left": _over(joins.orders_with_payments),
    "join_left_on_filter": _over(joins.customers_with_live_orders),
    "join_anti": _over(joins.orders_without_items),
    "join_aligned": _over(joins.payments_beside_orders),
    "agg_count": _over(aggregates.orders_per_status),
    "agg_distinct": _over(aggregates.buyers_per_status),
    "agg_distinct_case": _over(aggregates.buyers_by_recency, as_of=AS_OF, days=90),
    "agg_sum_avg": _over(aggregates.amounts_per_method),
    "agg_sum_expression": _over(aggregates.cost_and_profit_per_category),
    "agg_conditional": _over(aggregates.failures_per_method),
    "agg_pivot_case": _over(aggregates.amounts_by_outcome),
    "agg_min_max": _over(aggregates.order_span_per_status),
    "agg_global": _over(aggregates.order_totals),
    "agg_two_keys": _over(aggregates.orders_per_country_tier),
    "agg_expression_key": _over(aggregates.orders_per_month),
    "agg_dependent_columns": _over(aggregates.orders_per_customer),
    "agg_two_level": _over(aggregates.customers_per_order_count),
    "agg_having": _over(aggregates.large_cities, min_customers=5),
    "agg_arithmetic": _over(aggregates.revenue_per_buyer),
    "agg_totals_to_parent": _over(reconcile.orders_with_item_totals),
    "window_partition_max": _over(windows.price_beside_category_max),
    "window_rolling_rows": _over(windows.rolling_week),
    "window_lag": _over(windows.revenue_week_before),
    "window_over_group": _over(windows.first_month_of_customers),
    "window_first_value": _over(windows.orders_against_first_month),
    "topk": _over(ordering.best_selling_products, n=20),
    "sort_keys": _over(ordering.customers_by_place),
    "scalar_concat": _over(scalars.customer_names),
    "scalar_julianday": _over(scalars.payment_delay, since=dt.date(1995, 1, 1)),
    "scalar_calendar": _over(scalars.order_calendar),
    "scalar_date_offset": _over(scalars.date_offsets, as_of=AS_OF),
    "scalar_nullif_round": _over(scalars.unit_prices),
    "scalar_percent_label": _over(scalars.margins),
    "scalar_case_label": _over(scalars.risk_labels),
    "scalar_int_div": _over(scalars.stock_per_price),
    "scalar_clamp": _over(scalars.status_for_age, as_of=AS_OF),
    "scalar_text": _over(scalars.text_parts),
    "scalar_lookup_default": _over(scalars.ranges_by_category),
    "scalar_null_test": _over(scalars.missing_scores),
    "scalar_format": _over(scalars.formatted_shares),
}



def _validation(tables: Tables) -> DataFrame:
    """The validation result of every table, its parts as plain columns."""
    results = stack([load.validation_result(tables[t.name], t) for t in TABLES.values()])
    return results.select(
        "table_name",
        "is_valid",
        F.array_join("issues", ", ").alias("issues"),
        "summary.total_rows",
        "summary.total_columns",
        F.aggregate(
            F.map_values("summary.null_count"), F.lit(0).cast("bigint"), lambda a, b: a + b
        ).alias("null_values"),
    )


def _violating_payments(tables: Tables) -> DataFrame:
    """Payments that do not fit their order, each with the rules it breaks."""
    together = reconcile.payments_with_orders(tables)
    bad = rows.violating_rows(together, reconcile.payment_rules())
    return bad.select("payment_id", F.array_join("violated_rules", ", ").alias("violated_rules"))


def _repeated_line_ids(tables: Tables) -> DataFrame:
    return keys.duplicates(tables["order_items"], "order_item_id")


QUALITY: dict[str, Query] = {
    "dq_nulls": _over(rows.check_nulls),
    "dq_ranges": _over(rows.check_ranges),
    "dq_declared": _over(rows.check_declared, shipping=True),
    "dq_domains": _over(rows.check_domains),
    "dq_line_amounts": _over(rows.check_lines),
    "dq_unique": _over(keys.check_unique),
    "dq_fk": _over(keys.check_references),
    "dq_profile": _over(profile.profile_tables, shipping=True),
    "dq_order_reconciliation": _over(reconcile.order_reconciliation),
    "dq_order_reconciliation_summary": _over(reconcile.order_reconciliation_summary),
    "dq_payment_reconciliation": _over(reconcile.check_payments),
    "dq_pricing": _over(reconcile.check_pricing),
    "dq_violating_payments": _over(_violating_payments),
    "dq_duplicate_keys": _over(_repeated_line_ids),
    "dq_integrity": _over(integrity.check_integrity),
    "dq_validation": _over(_validation, shipping=True),
    "table_schema_doc": _over(profile.schema_document, shipping=True),
}


def _as_doubles(df: DataFrame) -> DataFrame:
    money = [c for c, t in df.dtypes if t.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in money}) if money else df


def _csv_round_trip(table: Table) -> Query:
    """Write a table as CSV and read it back with its declared types."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = f"{shared_folder(spark, 'csv')}/{table.name}.csv"
        tables = star_tables(spark, folder, shipping=True)
        csv_files.write_csv(parquet_files.declared_columns(tables[table.name], table), path)
        return _as_doubles(csv_files.read_csv(spark, path, table))

    return query


def _stored(table: Table) -> Query:
    """Store a table in its layout and read it back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = shared_folder(spark, "stored")
        tables = star_tables(spark, folder, shipping=True)
        parquet_files.write_table(tables[table.name], root, table)
        return _as_doubles(parquet_files.read_table(spark, root, table))

    return query


def _load_report(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_folder(spark, "load")
    return load.status_frame(spark, load.load_tables(star_tables(spark, folder, True), root))


def _load_report_json(spark: SparkSession, folder: str) -> DataFrame:
    """The report that a load writes, read back: a row per table."""
    root = shared_folder(spark, "load")
    statuses = load.load_tables(star_tables(spark, folder, True), root)
    load.write_report(spark, statuses, root, f"{root}-report")
    report = spark.read.schema(
        "success_rate string, summary string, tables map<string,boolean>"
    ).json(f"{root}-report")
    return report.select(F.explode("tables").alias("table_name", "ok"), "success_rate", "summary")


def _append_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Store the orders of even ids, append the others, read all."""
    root = shared_folder(spark, "stored")
    orders = star_tables(spark, folder, shipping=True)["orders"]
    statuses = [
        load.load_table(orders.filter("order_id % 2 = 0"), ORDERS, root),
        load.load_table(orders.filter("order_id % 2 = 1"), ORDERS, root, load.APPEND),
    ]
    load.require_all(statuses)
    return _as_doubles(parquet_files.read_table(spark, root, ORDERS))


def _appended(report: Callable[[SparkSession, str, Tables], DataFrame], state: str) -> Query:
    """A report from states: those of the first orders are made before the others are appended."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = shared_folder(spark, "stored")
        tables = star_tables(spark, folder, shipping=True)
        orders = tables["orders"]
        load.require_all([load.load_table(orders.filter("order_id % 2 = 0"), ORDERS, root)])
        states.refresh(spark, root, state)
        load.require_all([load.load_table(orders.filter("order_id % 2 = 1"), ORDERS, root, load.APPEND)])
        return report(spark, root, tables)

    return query


def _append_daily_trends(spark: SparkSession, folder: str) -> DataFrame:
    """Daily trends from states: those of half the orders and payments are made before the rest is appended."""
    root = shared_folder(spark, "stored")
    tables = star_tables(spark, folder, shipping=True)
    for half, mode in ((0, load.REPLACE), (1, load.APPEND)):
        parts = [
            (tables["orders"].filter(f"order_id % 2 = {half}"), ORDERS),
            (tables["payments"].filter(f"payment_id % 3 % 2 = {half}"), PAYMENTS),
        ]
        load.require_all([load.load_table(df, table, root, mode) for df, table in parts])
        daily = states.daily_figures(spark, root, days=30 + trends.WEEK)
    return trends.trends_of(daily, CORRECTED)


def _append_references(spark: SparkSession, folder: str) -> DataFrame:
    """The references of appended orders to stored customers, some of whom are missing."""
    root = shared_folder(spark, "stored")
    tables = star_tables(spark, folder, shipping=True)
    orders = tables["orders"]
    known = [(tables["customers"].filter("customer_id % 7 <> 0"), CUSTOMERS), (orders.filter("order_id % 2 = 0"), ORDERS)]
    load.require_all([load.load_table(df, table, root) for df, table in known])
    load.require_all([load.load_table(orders.filter("order_id % 2 = 1"), ORDERS, root, load.APPEND)])
    return load.appended_references(spark, root, ORDERS)


def _look_up_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Stored orders of some customers, from the files that hold any."""
    root = shared_folder(spark, "stored")
    tables = star_tables(spark, folder, shipping=True)
    parquet_files.write_table(tables["orders"], root, ORDERS)
    return _as_doubles(parquet_files.look_up(spark, root, ORDERS, "customer_id", 10, 60))


def _bucketed_order_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the totals of their lines, from tables in buckets of the order id."""
    root = shared_folder(spark, "bucketed")
    database = f"tillmetrics_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/catalog'")
    bucketed.store(star_tables(spark, folder, shipping=True), root, database, buckets=8)
    return reconcile.orders_with_item_totals(bucketed.tables(spark, database))


def _load_refused(spark: SparkSession, folder: str) -> DataFrame:
    """Loads that must fail, one by one: why, and what is stored afterwards."""
    root = shared_folder(spark, "stored")
    tables = star_tables(spark, folder, shipping=True)
    faulty = [
        ("orders", ORDERS, lambda: tables["orders"]),
        ("orders again", ORDERS, lambda: tables["orders"].filter("order_id % 3 = 0")),
        (
            "customers without city",
            CUSTOMERS,
            lambda: tables["customers"].withColumn("city", F.expr("IF(customer_id % 11 <> 0, city, NULL)")),
        ),
        (
            "products below zero",
            PRODUCTS,
            lambda: tables["products"].withColumn("price", F.expr("IF(product_id % 7 = 0, -price, price)")),
        ),
        (
            "payments from a file that is not there",
            PAYMENTS,
            lambda: csv_files.read_csv(spark, f"{root}/nowhere.csv", PAYMENTS),
        ),
    ]
    found = []
    for step, table, rows_of in faulty:
        source = TableSet({table.name: rows_of})
        (status,) = load.load_tables(source, root, load.APPEND, names=[table.name])
        stored = parquet_files.version(spark, root, table)
        found.append((step, status.ok, status.row_count, status.reason, sum(p.rows for p in stored.parts)))
    return spark.createDataFrame(
        found, "step string, ok boolean, row_count bigint, reason string, stored_rows bigint"
    )


def _catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Declare stored tables in the catalog and ask them in SQL."""
    root = shared_folder(spark, "stored")
    tables = star_tables(spark, folder, shipping=True)
    for table in (CUSTOMERS, ORDERS):
        parquet_files.write_table(tables[table.name], root, table)
    database = f"tillmetrics_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/catalog'")
    parquet_files.create_tables(spark, root, database)
    return spark.sql(
        "SELECT c.country, o.status, count(*) AS order_count, CAST(sum(o.total_amount) AS DOUBLE) AS revenue "
        f"FROM {database}.customers c JOIN {database}.orders o ON c.customer_id = o.customer_id "
        "GROUP BY c.country, o.status"
    )


def _load_then_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Load the tables a report needs, then run it on the stored ones."""
    root = shared_folder(spark, "load")
    names = [CUSTOMERS.name, ORDERS.name]
    load.require_all(load.load_tables(star_tables(spark, folder, True), root, names=names))
    return customers.customer_ltv_segments(parquet_files.stored_tables(spark, root))


_SQL_TEXT = """
SELECT c.customer_tier, count(*) AS order_count, CAST(sum(o.total_amount) AS DOUBLE) AS revenue
FROM {customers} c JOIN {orders} o ON c.customer_id = o.customer_id
WHERE o.status <> 'cancelled'
GROUP BY c.customer_tier
"""


def _sql_text(spark: SparkSession, folder: str) -> DataFrame:
    return sql.run_sql(spark, _SQL_TEXT, star_tables(spark, folder))


FILES: dict[str, Query] = {
    "csv_round_trip_customers": _csv_round_trip(CUSTOMERS),
    "csv_round_trip_products": _csv_round_trip(PRODUCTS),
    "csv_round_trip_orders": _csv_round_trip(ORDERS),
    "csv_round_trip_order_items": _csv_round_trip(ORDER_ITEMS),
    "csv_round_trip_payments": _csv_round_trip(PAYMENTS),
    "stored_customers": _stored(CUSTOMERS),
    "stored_products": _stored(PRODUCTS),
    "stored_orders": _stored(ORDERS),
    "stored_order_items": _stored(ORDER_ITEMS),
    "stored_payments": _stored(PAYMENTS),
    "append_orders": _append_orders,
    "append_ltv_segments": _appended(
        lambda spark, root, tables: customers.segments_of(
            customers.ltv_of(states.customers_orders(spark, root), tables["customers"])
        ),
        "customer_months",
    ),
    "append_cohort_activity": _appended(
        lambda spark, root, tables: cohorts.cohort_activity_of(
            states.customer_months(spark, root), tables["customers"]
        ),
        "customer_months",
    ),
    "append_distinct_buyers": _appended(
        lambda spark, root, _: states.distinct_buyers(spark, root).union(
            states.distinct_buyers(spark, root, chars=4)
        ),
        "buyer_bitmaps",
    ),
    "append_daily_trends": _append_daily_trends,
    "append_references": _append_references,
    "bucketed_order_totals": _bucketed_order_totals,
    "look_up_orders": _look_up_orders,
    "load_refused": _load_refused,
    "load_report": _load_report,
    "load_report_json": _load_report_json,
    "catalog_tables": _catalog_tables,
    "load_then_segments": _load_then_segments,
    "sql_text": _sql_text,
}


def all_queries() -> dict[str, Query]:
    return {**REPORTS, **OPERATORS, **QUALITY, **FILES}
