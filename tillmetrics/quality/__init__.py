"""Checks of whole tables. Each returns rows: table, check, column, violations, passed.

Conditions are SQL text, which a table of many rules can be read from at a glance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

CHECK_COLUMNS = "table_name, check_name, column_name, violations, passed"


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unfold(one_row: DataFrame, rows: list[str], columns: str) -> DataFrame:
    """Turn the single row of ``one_row`` into several, each a list of SQL expressions."""
    return one_row.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({columns})")


def check_row(table: str, check: str, column: str, violations: str) -> str:
    return f"'{table}', '{check}', '{column}', {violations}, {violations} = 0"
