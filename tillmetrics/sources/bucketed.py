"""Orders, their lines and payments stored by buckets of the order id, for joins without a shuffle.

The catalog knows how the files are dealt, so joining any two of the tables by order, and
grouping one by it, happens where the files are read. Spark does not split a bucket, so a table in which one
order has ``hot_rows`` rows or more is stored without buckets: its joins shuffle, and Spark splits
what is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmetrics.operators.joins import HOT_ROWS, frequent_keys
from tillmetrics.plans import Tables
from tillmetrics.schemas import TABLES
from tillmetrics.sources import TableSet, parquet_files

KEY = "order_id"
BUCKETED = ("orders", "order_items", "payments")


def store(
    tables: Tables, root: str, database: str, buckets: int, hot_rows: int = HOT_ROWS
) -> list[str]:
    """Write the tables as ``database``'s, files below ``root``; returns those in buckets.

    ``buckets`` must be the same for all, some hundred MB each of the largest table.
    """
    done = []
    for name in BUCKETED:
        df = parquet_files.declared_columns(tables[name], TABLES[name])
        hot = frequent_keys(df, KEY, hot_rows)
        # Dealt as the buckets are, so that each is one file.
        writer = df.repartition(buckets, KEY).write.mode("overwrite") if not hot else df.write.mode("overwrite")
        if not hot:
            writer = writer.bucketBy(buckets, KEY).sortBy(KEY)
            done.append(name)
        writer.option("path", f"{root}/{name}").saveAsTable(f"`{database}`.`{name}`")
    return done


def tables(spark: SparkSession, database: str) -> TableSet:
    def table(name: str) -> DataFrame:
        return spark.table(f"`{database}`.`{name}`")

    return TableSet({name: lambda n=name: table(n) for name in BUCKETED})
