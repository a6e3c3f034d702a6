"""Descriptions of tables: columns, types, rows and NULLs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillmetrics.plans import Tables
from tillmetrics.quality import stack, unfold
from tillmetrics.schemas import TABLES


def profile(df: DataFrame, table_name: str) -> DataFrame:
    """Rows, columns and NULLs per declared column, in one scan.

    Columns that storing or parsing add, as the month folder, are not the table's.
    """
    declared = TABLES[table_name].columns if table_name in TABLES else df.columns
    columns = [c for c in df.columns if c in declared]
    nulls = [f"count_if({c} IS NULL) AS nulls_{c}" for c in columns]
    counted = df.selectExpr("count(*) AS total_rows", *nulls)
    width = len(columns)
    return unfold(
        counted,
        [f"'{table_name}', '{c}', total_rows, {width}, nulls_{c}" for c in columns],
        "table_name, column_name, total_rows, total_columns, null_count",
    )


def profile_tables(tables: Tables) -> DataFrame:
    return stack([profile(tables[name], name) for name in TABLES])


def schema_document(tables: Tables) -> DataFrame:
    """Per declared column: position, type, and the table's row count and description."""
    frames = []
    for name, table in TABLES.items():
        df = tables[name]
        lines = [
            f"'{name}', {i}, '{column}', '{data_type}', row_count, '{table.description}'"
            for i, (column, data_type) in enumerate(df.select(*table.columns).dtypes, 1)
        ]
        columns = "table_name, position, column_name, data_type, row_count, description"
        frames.append(unfold(df.selectExpr("count(*) AS row_count"), lines, columns))
    return stack(frames)
