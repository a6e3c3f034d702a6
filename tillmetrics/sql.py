"""SQL text over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmetrics.plans import Tables
from tillmetrics.schemas import TABLES

# Functions of the SQL the reports are customarily written in, as SQL functions that Spark
# inlines into the plan.
_FUNCTIONS = {
    "julianday": """(moment TIMESTAMP_NTZ) RETURNS DOUBLE RETURN
        2440587.5D + CAST(CAST(CAST(moment - TIMESTAMP_NTZ'1970-01-01 00:00:00'
                               AS INTERVAL SECOND) AS DECIMAL(20,6)) AS DOUBLE) / 86400D""",
    "strftime": """(format STRING, moment TIMESTAMP_NTZ) RETURNS STRING RETURN
        date_format(moment, replace(replace(replace(replace(replace(replace(format,
            '%Y', 'yyyy'), '%m', 'MM'), '%d', 'dd'), '%H', 'HH'), '%M', 'mm'), '%S', 'ss'))""",
}


def run_sql(spark: SparkSession, text: str, tables: Tables) -> DataFrame:
    """Run ``text``, in which ``{orders}`` stands for the table orders, without making views."""
    used = {name: tables[name] for name in TABLES if f"{{{name}}}" in text}
    return spark.sql(text, **used)


def create_views(tables: Tables) -> None:
    """Temporary views named like the tables, for SQL text that names them plainly."""
    for name in TABLES:
        tables[name].createOrReplaceTempView(name)


def create_functions(spark: SparkSession) -> None:
    for name, definition in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{definition}")
