"""Published tables: one folder per table under a root folder, of Parquet files in versions."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.functions.dates import year_month
from tillmetrics.schemas import TABLES, Table
from tillmetrics.sources import TableSet, access, key_index, snapshots
from tillmetrics.sources.snapshots import Part, Version, remove

# Where a table is cut into folders; within them rows follow a curve over the indexed columns.
# Statistics of files and row groups on these then let scans skip, which is what indexes are for.
MONTH = {"orders": ("order_month", "order_date"), "payments": ("payment_month", "payment_date")}

_PLACE = "_place"  # on the curve
_FLAGS = "_flags"  # of each row, a bit per condition it meets


def declared_columns(df: DataFrame, table: Table, *more: Column) -> DataFrame:
    """Only the declared columns, in order and type; NaN becomes NULL."""
    columns = []
    for f in table.schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if isinstance(f.dataType, T.DoubleType):
            c = F.when(~F.isnan(c), c)
        columns.append(c.alias(f.name))
    return df.select(*columns, *more)


def write_part(
    df: DataFrame,
    root: str,
    table: Table,
    partitions: int | None = None,
    rules: dict[str, str] | None = None,
) -> tuple[Part, dict[str, int]]:
    """Write the declared columns in the table's layout, in a folder no version lists yet.

    Rows are ordered by month and place on a curve over the indexed columns, whose
    ranks take a pass over these columns. Range partitioning on a key that ends in a unique
    column splits a hot month or customer over many tasks and still gives each month few
    files. Without ``partitions`` the session's number of shuffle partitions applies.

    ``rules`` are conditions on the rows of ``df`` by name; how many rows meet each is
    counted while they are written, so that it takes no scan of its own.
    """
    spark = df.sparkSession
    rules = rules or {}
    met = [F.expr(f"IF({condition}, 1L, 0L)") * F.lit(1 << i) for i, condition in enumerate(rules.values())]
    flags = reduce(lambda a, b: a + b, met, F.lit(0).cast("bigint"))
    out = declared_columns(df, table, flags.alias(_FLAGS))
    known = access.borders(out, access.INDEXED[table.name])
    out = out.withColumn(_PLACE, access.curve_place(out, known))
    order = [_PLACE, table.primary_key]
    folder_column = None
    if table.name in MONTH:
        folder_column, moment = MONTH[table.name]
        out = out.withColumn(folder_column, year_month(moment))
        order = [folder_column, *order]
    keys = order if partitions is None else [partitions, *order]
    # Observed behind the exchange, where each row passes once: range partitioning samples what is before.
    counted = Observation()
    flag = [F.count_if(F.col(_FLAGS).bitwiseAND(1 << i) != 0).alias(f"rule_{i}") for i in range(len(rules))]
    dealt = out.repartitionByRange(*keys).sortWithinPartitions(*order)
    dealt = dealt.observe(counted, F.count("*").alias("rows"), *flag).drop(_FLAGS, _PLACE)
    writer = dealt.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "1")
    if folder_column:
        writer = writer.partitionBy(folder_column)
    folder = snapshots.new_folder()
    try:
        writer.parquet(f"{root}/{table.name}/{folder}")
    except Exception:
        remove(spark, f"{root}/{table.name}/{folder}")
        raise
    found = counted.get
    return Part(folder, found["rows"]), {name: found[f"rule_{i}"] for i, name in enumerate(rules)}


def discard_part(spark: SparkSession, root: str, table: Table, part: Part) -> None:
    for folder in (part.folder, snapshots.index_folder(part), snapshots.beside(part, "files")):
        remove(spark, f"{root}/{table.name}/{folder}")


def read_part(spark: SparkSession, root: str, table: Table, part: Part) -> DataFrame:
    return _read(spark, root, table, (part,))


def indexed(spark: SparkSession, root: str, table: Table, part: Part) -> Part:
    """The part with the ranges of its keys; their index and the files' ranges are written beside it."""
    rows = read_part(spark, root, table, part)
    access.write_file_ranges(spark, rows, table, f"{root}/{table.name}/{snapshots.beside(part, 'files')}")
    keys = key_index.ranges(rows, (table.primary_key, *table.unique))
    key_index.write(rows, keys, f"{root}/{table.name}/{snapshots.index_folder(part)}")
    return replace(part, keys=keys)


def publish_part(
    spark: SparkSession, root: str, table: Table, base: Version, part: Part, mode: str = "overwrite"
) -> Version:
    """Let the part take the table's place, or join its rows, in one step."""
    parts = (part,) if mode == "overwrite" else (*base.parts, part)
    return snapshots.publish(spark, f"{root}/{table.name}", base, parts)


def write_table(
    df: DataFrame, root: str, table: Table, mode: str = "overwrite", partitions: int | None = None
) -> None:
    """Store rows without any check; ``load.load_table`` checks them first."""
    spark = df.sparkSession
    part = indexed(spark, root, table, write_part(df, root, table, partitions)[0])
    try:
        publish_part(spark, root, table, version(spark, root, table), part, mode)
    except snapshots.Conflict:
        discard_part(spark, root, table, part)
        raise


def version(spark: SparkSession, root: str, table: Table) -> Version:
    """What readers of the table see now."""
    return snapshots.newest(spark, f"{root}/{table.name}")


def vacuum(spark: SparkSession, root: str, hours: float = 24.0) -> None:
    """Remove rows that were replaced, and what failed writes left, longer ago than ``hours``."""
    for name in TABLES:
        snapshots.vacuum(spark, f"{root}/{name}", hours)


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` by way of Parquet files, for a source that is slow to read and read repeatedly."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _schema(table: Table) -> T.StructType:
    months = [T.StructField(MONTH[table.name][0], T.StringType())] if table.name in MONTH else []
    return T.StructType([*table.schema.fields, *months])


def _read(spark: SparkSession, root: str, table: Table, parts: tuple[Part, ...]) -> DataFrame:
    return snapshots.read(spark, f"{root}/{table.name}", parts, _schema(table))


def read_table(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The table's rows as of now; later versions do not change what the frame reads."""
    now = version(spark, root, table)
    if not now.parts:
        raise FileNotFoundError(f"{root}/{table.name} is not stored")
    return _read(spark, root, table, now.parts)


def look_up(
    spark: SparkSession, root: str, table: Table, column: str, low: object, high: object = None
) -> DataFrame:
    """Rows whose ``column``, an indexed one, is from ``low`` to ``high``, or ``low``.

    Only files whose range of the column meets that are opened.
    """
    high = low if high is None else high
    now = version(spark, root, table)
    if not now.parts:
        raise FileNotFoundError(f"{root}/{table.name} is not stored")
    ranges = access.file_ranges(spark, root, table, now.parts)
    files = [r["file"] for r in access.files_with(ranges, column, low, high).select("file").collect()]
    names = [unquote(f) for f in files]  # as the scan's own list of files, one name each
    rows = snapshots.read_files(spark, f"{root}/{table.name}", names, _schema(table)) if names else None
    if rows is None:
        return spark.createDataFrame([], _schema(table))
    return rows.filter(F.col(column).between(F.lit(low), F.lit(high)))


def stored_tables(spark: SparkSession, root: str) -> TableSet:
    return TableSet({name: lambda t=t: read_table(spark, root, t) for name, t in TABLES.items()})


def is_stored(spark: SparkSession, root: str, table: Table) -> bool:
    return bool(version(spark, root, table).parts)


def create_tables(
    spark: SparkSession, root: str, database: str = "default", refresh: bool = False
) -> None:
    """Declare the five tables in the catalog over ``root``, where they do not exist yet.

    They are views of the versions that are stored now, empty ones of tables that are
    not; ``refresh`` moves existing ones to the newest versions.
    """
    create = "CREATE OR REPLACE VIEW" if refresh else "CREATE VIEW IF NOT EXISTS"
    for table in TABLES.values():
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.schema.fields)
        missing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.schema.fields)
        parts = [p for p in version(spark, root, table).parts if p.rows]
        selects = [f"SELECT {columns} FROM parquet.`{root}/{table.name}/{p.folder}`" for p in parts]
        body = " UNION ALL ".join(selects) or f"SELECT {missing} WHERE false"
        spark.sql(f"{create} `{database}`.`{table.name}` COMMENT '{table.description}' AS {body}")
