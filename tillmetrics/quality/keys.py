"""Checks of keys: uniqueness and references.

Keys are counted before they meet another table, so a key with a third of all
rows arrives as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.plans import Tables
from tillmetrics.quality import CHECK_COLUMNS, check_row, stack, unfold
from tillmetrics.schemas import TABLES


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once; NULLs do not collide."""
    present = df.filter(F.col(column).isNotNull())
    return present.groupBy(column).agg(F.count("*").alias("copies")).filter("copies > 1")


def unique_violations(df: DataFrame, table_name: str, column: str) -> DataFrame:
    """Violations are the rows beyond the first of each value."""
    total = duplicates(df, column).selectExpr("coalesce(sum(copies - 1), 0) AS surplus")
    return unfold(total, [check_row(table_name, "unique", column, "surplus")], CHECK_COLUMNS)


def orphans(child: DataFrame, parent: DataFrame, column: str, key: str) -> DataFrame:
    """References without a parent row and how many child rows hold each; NULL refers to nothing."""
    references = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("reference"))
        .agg(F.count("*").alias("child_rows"))
    )
    keys = parent.select(F.col(key).alias("reference"))
    return references.join(keys, "reference", "left_anti")


def reference_violations(
    child: DataFrame, parent: DataFrame, table_name: str, column: str, key: str
) -> DataFrame:
    lost = orphans(child, parent, column, key)
    total = lost.selectExpr("coalesce(sum(child_rows), 0) AS lost")
    return unfold(total, [check_row(table_name, "reference", column, "lost")], CHECK_COLUMNS)


def check_unique(tables: Tables) -> DataFrame:
    return stack(
        [
            unique_violations(tables[t.name], t.name, column)
            for t in TABLES.values()
            for column in (t.primary_key, *t.unique)
        ]
    )


def check_references(tables: Tables) -> DataFrame:
    return stack(
        [
            reference_violations(
                tables[t.name], tables[parent], t.name, column, TABLES[parent].primary_key
            )
            for t in TABLES.values()
            for column, parent in t.foreign_keys.items()
        ]
    )
