"""CSV files with a header: columns are matched by name and typed as declared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.schemas import TABLES, Table
from tillmetrics.sources import TableSet, csv_records

# The texts that stand for a missing value in the input files.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

MALFORMED = "_malformed"  # fields of the row that do not fit the type; one more if their number is wrong
_BROKEN = "_broken_row"  # text of a row with more or fewer fields than the header

_FORMAT = {"header": True, "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str,
    table: Table,
    keep_malformed: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """The declared columns of ``table``; other columns of the file are dropped.

    A declared column the file lacks is NULL, and so is a field that does not fit
    its type; ``keep_malformed`` adds a count of the latter for validation, in which a
    row with more or fewer fields than the header counts as well. All files of a folder
    must have the same header; reading fails at one that differs.
    ``multi_line`` accepts line breaks inside quotes; files are then read twice, by many tasks.
    """
    raw, present = _quoted_lines(spark, path) if multi_line else _plain_lines(spark, path, keep_malformed)
    typed, bad = [], []
    for f in table.schema.fields:
        if f.name not in present:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.when(~F.col(f.name).isin(*MISSING), F.col(f.name))
        value = _parse(text, f.dataType)
        typed.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            bad.append((text.isNotNull() & value.isNull()).cast("int"))
    if keep_malformed:
        total = F.col(_BROKEN).isNotNull().cast("int") if present else F.lit(0)
        for b in bad:
            total = total + b
        typed.append(total.alias(MALFORMED))
    return raw.select(*typed)


def _plain_lines(spark: SparkSession, path: str, keep_malformed: bool) -> tuple[DataFrame, set[str]]:
    """Rows as texts of files without line breaks inside quotes, and the columns they have."""
    raw = spark.read.options(**_FORMAT).csv(path)
    present = set(raw.columns)
    if present:  # the first header found holds for every file
        schema = raw.schema.add(_BROKEN, T.StringType()) if keep_malformed else raw.schema
        options = {**_FORMAT, "columnNameOfCorruptRecord": _BROKEN}
        raw = spark.read.schema(schema).options(**options, enforceSchema=False).csv(path)
    return raw, present


def _quoted_lines(spark: SparkSession, path: str) -> tuple[DataFrame, set[str]]:
    """The same of files whose quoted fields may hold line breaks."""
    names, found = csv_records.with_header(csv_records.records(spark, path))
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
    schema = T.StructType([*fields, T.StructField(_BROKEN, T.StringType())])
    options = {**_FORMAT, "header": "false", "columnNameOfCorruptRecord": _BROKEN}
    row = F.from_csv("text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    parsed = found.select(row.alias("row"))
    columns = [F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)]
    return parsed.select(*columns, F.col(f"row.{_BROKEN}").alias(_BROKEN)), set(names)


def _parse(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    text = F.trim(text)
    if isinstance(data_type, T.IntegralType):
        text = F.regexp_replace(text, r"\.0+$", "")  # whole numbers written as 12.0
    value = text.try_cast(data_type)
    if isinstance(data_type, T.DoubleType):
        value = F.when(~F.isnan(value), value)
    if isinstance(data_type, T.DecimalType):
        exact = text.try_cast(T.DecimalType(38, 18))
        value = F.when(value == exact, value)  # more places than the column keeps do not fit it
    return value


def csv_tables(spark: SparkSession, folder: str, **options: bool) -> TableSet:
    """Every declared table from ``folder/<table>.csv`` (a file or a folder of parts)."""
    return TableSet(
        {
            name: lambda t=table: read_csv(spark, f"{folder}/{t.name}.csv", t, **options)
            for name, table in TABLES.items()
        }
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` with CSV parts, each with a header row."""
    columns = [
        F.initcap(F.col(f.name).cast("string")).alias(f.name)  # True / False
        if isinstance(f.dataType, T.BooleanType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    (
        df.select(*columns)
        .write.mode("overwrite")
        .options(**_FORMAT, timestampNTZFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(path)
    )
