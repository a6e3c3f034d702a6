"""The whole run: load a folder of CSV files, describe the tables, write every report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics import load
from tillmetrics.plans import Tables, cohorts, customers, kpi, payments, products, trends
from tillmetrics.quality.integrity import check_integrity
from tillmetrics.quality.profile import schema_document
from tillmetrics.sources.parquet_files import stored_tables


def all_reports(tables: Tables, as_of: dt.date) -> dict[str, DataFrame]:
    return {
        "customer_ltv_segments": customers.customer_ltv_segments(tables),
        "product_performance": products.product_performance(tables),
        "daily_trends": trends.daily_trends(tables),
        "cohort_retention": cohorts.cohort_retention(tables),
        "payment_risk": payments.payment_risk(tables),
        "kpi_dashboard": kpi.kpi_dashboard(tables, as_of),
        "sales_by_category_tier": products.sales_by_category_tier(tables),
        "customer_geography": customers.customer_geography(tables),
        "top_products": products.top_products(tables),
        "tier_summary": customers.tier_summary(tables),
    }


def write_schema_document(tables: Tables, path: str) -> None:
    """One JSON record per table: description, row count, columns and types."""
    per_table = (
        schema_document(tables)
        .groupBy("table_name", "description", "row_count")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("position", "column_name", "data_type"))
            ).alias("columns")  # as many as the table has columns
        )
    )
    per_table.coalesce(1).write.mode("overwrite").json(path)


def run(
    spark: SparkSession,
    csv_folder: str,
    root: str,
    report_folder: str,
    as_of: dt.date,
    mode: str = load.REPLACE,
    multi_line: bool = False,
) -> list[load.LoadStatus]:
    """Load, check the tables against each other, then report.

    Raises when a table was refused, after writing the load report. Lost references and unsound
    values stop nothing: they are written as ``integrity``, a row per check, beside the reports
    from whose inner joins such rows are missing.
    """
    statuses = load.load_csv_folder(spark, csv_folder, root, mode, multi_line=multi_line)
    load.write_report(spark, statuses, root, f"{report_folder}/load")
    load.require_all(statuses)
    tables = stored_tables(spark, root)
    check_integrity(tables).coalesce(1).write.mode("overwrite").parquet(f"{report_folder}/integrity")
    write_schema_document(tables, f"{report_folder}/schema")
    for name, report in all_reports(tables, as_of).items():
        report.write.mode("overwrite").parquet(f"{report_folder}/{name}")
    return statuses
