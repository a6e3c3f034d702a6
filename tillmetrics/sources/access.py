"""Access paths of stored tables: rows near each other in several columns, and which files hold a value.

What an index on several columns does, the layout does here. A row's place on a space-filling
curve has the bits of its columns' ranks in turn, so rows near each other in any of the columns
tend to share a file. Of each file the least and largest values of the indexed columns are
kept beside the part; a lookup by any of them asks this short table first and opens only files
whose range holds the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.schemas import Table
from tillmetrics.sources import snapshots
from tillmetrics.sources.snapshots import Part

# The columns that lookups go by.
INDEXED = {
    "customers": ("email", "country", "customer_tier"),
    "products": ("product_id", "category"),
    "orders": ("customer_id", "order_date", "status"),
    "order_items": ("order_id", "product_id"),
    "payments": ("order_id", "payment_status", "payment_date"),
}

RANK_BITS = 6  # of each column; 64 ranks of about as many rows each
_TEXT_BYTES = 7  # of a text that its rank goes by


def _number(column: Column, kind: T.DataType) -> Column:
    """A whole number in the order of the values, near enough for texts."""
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0")
        return F.conv(head, 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.unix_micros(column.cast("timestamp"))
    return column.cast("bigint")


def borders(df: DataFrame, columns: tuple[str, ...]) -> dict[str, list[int]]:
    """The values between a column's ranks, from one pass over the columns."""
    shares = [i / (1 << RANK_BITS) for i in range(1, 1 << RANK_BITS)]
    found = df.agg(
        *[F.percentile_approx(_number(F.col(c), df.schema[c].dataType), shares, 1000).alias(c) for c in columns]
    ).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def curve_place(df: DataFrame, known: dict[str, list[int]]) -> Column:
    """A row's place on the curve; a null comes first in its column.

    What a column adds to the place is found among its borders by halving, in a tree of plain
    comparisons, which Spark compiles.
    """
    place = F.lit(0).cast("bigint")
    for i, (name, values) in enumerate(known.items()):
        number = _number(F.col(name), df.schema[name].dataType)
        # Few ranks are spread over all the bits, so that columns of few values weigh as much.
        ranks = [reached * (1 << RANK_BITS) // (len(values) + 1) for reached in range(len(values) + 1)]
        adds = [sum((rank >> bit & 1) << (bit * len(known) + i) for bit in range(RANK_BITS)) for rank in ranks]
        place = place + _halved(number, values, adds)
    return place


def _halved(number: Column, values: list[int], adds: list[int]) -> Column:
    """Of ``adds`` the one after as many as ``number`` has reached of the ascending ``values``; the first of a null."""
    if not values:
        return F.lit(adds[0]).cast("bigint")
    at = len(values) // 2
    above = _halved(number, values[at + 1 :], adds[at + 1 :])
    return F.when(number >= F.lit(values[at]).cast("bigint"), above).otherwise(_halved(number, values[:at], adds[: at + 1]))


def write_file_ranges(spark: SparkSession, rows: DataFrame, table: Table, path: str) -> None:
    """Least and largest value of each indexed column in each file of a part."""
    columns = INDEXED[table.name]
    named = rows.select(F.element_at(F.split("_metadata.file_path", "/data/"), -1).alias("file"), *columns)
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("least", F.min), ("largest", F.max))]
    found = named.groupBy("file").agg(F.count("*").alias("rows"), *bounds)
    found.coalesce(1).write.mode("overwrite").parquet(path)  # a row per file of the part


def file_ranges(spark: SparkSession, root: str, table: Table, parts: tuple[Part, ...]) -> DataFrame:
    columns = ", ".join(
        f"{n}_{c} {table.schema[c].dataType.simpleString()}" for c in INDEXED[table.name] for n in ("least", "largest")
    )
    paths = [f"{root}/{table.name}/{snapshots.beside(p, 'files')}" for p in parts]
    return spark.read.schema(f"file string, rows bigint, {columns}").parquet(*paths)


def files_with(ranges: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """The files that may hold a value from ``low`` to ``high``."""
    return ranges.filter((F.col(f"least_{column}") <= F.lit(high)) & (F.col(f"largest_{column}") >= F.lit(low)))
