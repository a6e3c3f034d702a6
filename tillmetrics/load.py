"""Validate tables and store them, one by one, parents first."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.quality import CHECK_COLUMNS, check_row, stack, unfold
from tillmetrics.quality.keys import unique_violations
from tillmetrics.quality.profile import profile
from tillmetrics.quality.rows import (
    Rule,
    count_violations,
    critical_nulls,
    declared,
    load_ranges,
)
from tillmetrics.schemas import TABLES, Table
from tillmetrics.session import shared_folder
from tillmetrics.sources import TableSet, csv_files, key_index, parquet_files
from tillmetrics.sources.snapshots import EMPTY, Conflict, Part

REPLACE = "overwrite"
APPEND = "append"


@dataclass(frozen=True)
class LoadStatus:
    table_name: str
    ok: bool
    row_count: int | None
    reason: str  # empty when loaded, else the checks that failed


def gate_rules(table: Table, df: DataFrame) -> list[Rule]:
    """What each row must keep: critical and required columns, ranges, readable fields.

    A length limit is reported by the quality checks but does not stop a load.
    """
    required = [r for r in declared(table) if r.check == "required"]
    rules = critical_nulls(table) + required + load_ranges(df)
    if csv_files.MALFORMED in df.columns:
        rules.append(Rule("malformed", "*", f"{csv_files.MALFORMED} > 0"))
    # Counted like a violation, so that the row count needs no scan of its own.
    return [*rules, Rule("rows", "*", "true")]


def validate(df: DataFrame, table: Table) -> DataFrame:
    """The load checks of one table."""
    frames = [count_violations(df, table.name, gate_rules(table, df))]
    for column in (table.primary_key, *table.unique):
        frames.append(unique_violations(df.select(column), table.name, column))
    return stack(frames)


def validation_result(df: DataFrame, table: Table) -> DataFrame:
    """One row: whether the table may be loaded, what is wrong, and its size and NULLs."""
    name = F.format_string("%s(%s)=%d", "check_name", "column_name", "violations")
    checks = validate(df, table).filter("check_name <> 'rows'")
    verdict = checks.agg(
        F.min("passed").alias("is_valid"),
        F.sort_array(F.collect_list(F.when(~F.col("passed"), name))).alias("issues"),
    )  # a few dozen checks
    summary = profile(df, table.name).agg(
        F.struct(
            F.max("total_rows").alias("total_rows"),
            F.max("total_columns").alias("total_columns"),
            F.map_from_entries(F.collect_list(F.struct("column_name", "null_count"))).alias(
                "null_count"
            ),  # one entry per column
        ).alias("summary")
    )
    return verdict.select(
        F.lit(table.name).alias("table_name"),
        "is_valid",
        "issues",
        summary.scalar().alias("summary"),
    )


def load_table(
    df: DataFrame, table: Table, root: str, mode: str = REPLACE, partitions: int | None = None
) -> LoadStatus:
    """Store ``df`` under ``root`` if every check holds, else nothing of it.

    Rows are written first, beside the table; the checks of single rows are counted on the
    way, keys are checked on what was written, those of an append against the index of the
    stored keys. Only then do the rows become part of the table, in one step. Should another
    writer have been faster, keys are checked against what it stored.
    """
    spark = df.sparkSession
    rules = {f"{r.check}({r.column})": r.violated for r in gate_rules(table, df) if r.check != "rows"}
    part, counts = parquet_files.write_part(df, root, table, partitions, rules)
    published = False
    try:
        part = parquet_files.indexed(spark, root, table, part)
        rows = parquet_files.read_part(spark, root, table, part)
        repeated = _surplus(rows, part, table)
        while not published:
            base = parquet_files.version(spark, root, table)
            stored = base if mode == APPEND else EMPTY
            for column in (table.primary_key, *table.unique):
                again = key_index.stored_again(
                    table, f"{root}/{table.name}", stored, column, rows, part.keys.get(column)
                )
                counts[f"unique({column})"] = repeated[column] + again
            failed = sorted(f"{name}={n}" for name, n in counts.items() if n)
            if failed:
                return LoadStatus(table.name, False, part.rows, ", ".join(failed))
            try:
                parquet_files.publish_part(spark, root, table, base, part, mode)
                published = True
            except Conflict:
                continue
        return LoadStatus(table.name, True, part.rows, "")
    finally:
        if not published:
            parquet_files.discard_part(spark, root, table, part)


def _surplus(rows: DataFrame, part: Part, table: Table) -> dict[str, int]:
    """Per unique column, the rows beyond the first of each key."""
    checks = stack([unique_violations(rows, table.name, c) for c in (table.primary_key, *table.unique)])
    return {r["column_name"]: r["violations"] for r in checks.collect()}  # one row per column


def appended_references(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The newest part's references to stored parents: a check row per column, as ``check_references``.

    Parents are asked by the index of their keys, so after an append its rows alone are read whole.
    """
    part = parquet_files.version(spark, root, table).parts[-1]
    rows = parquet_files.read_part(spark, root, table, part)
    frames = []
    for column, name in table.foreign_keys.items():
        parent = TABLES[name]
        held = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key"))
        held = held.agg(F.count("*").alias("child_rows"))
        now = parquet_files.version(spark, root, parent)
        lost = key_index.absent(parent, f"{root}/{name}", now, parent.primary_key, held)
        total = held.join(lost, "key").selectExpr("coalesce(sum(child_rows), 0) AS lost")
        frames.append(unfold(total, [check_row(table.name, "reference", column, "lost")], CHECK_COLUMNS))
    return stack(frames)


def load_tables(
    tables: Mapping[str, DataFrame],
    root: str,
    mode: str = REPLACE,
    names: list[str] | None = None,
    partitions: int | None = None,
) -> list[LoadStatus]:
    """Load every table; one that fails or cannot be read does not stop the others."""
    statuses = []
    for name in names or list(TABLES):
        if name not in TABLES:
            statuses.append(LoadStatus(name, False, None, "unknown table"))
            continue
        try:
            statuses.append(load_table(tables[name], TABLES[name], root, mode, partitions))
        except AnalysisException as e:
            reason = "missing file" if e.getCondition() == "PATH_NOT_FOUND" else str(e)
            statuses.append(LoadStatus(name, False, None, reason))
        except PySparkException as e:
            statuses.append(LoadStatus(name, False, None, str(e)))
        except OSError as e:  # a table that cannot be moved
            statuses.append(LoadStatus(name, False, None, str(e)))
        except Py4JJavaError as e:  # a corrupt file, a target that cannot be written
            statuses.append(LoadStatus(name, False, None, _root_cause(e)))
    return statuses


def _root_cause(error: Py4JJavaError) -> str:
    cause = error.java_exception
    while cause.getCause() is not None:
        cause = cause.getCause()
    return str(cause.toString())


def load_csv_folder(
    spark: SparkSession,
    folder: str,
    root: str,
    mode: str = REPLACE,
    partitions: int | None = None,
    multi_line: bool = False,
) -> list[LoadStatus]:
    """Load ``folder/<table>.csv`` of every declared table.

    Text is parsed once, into the shared folder; the checks then read only the
    columns they need of it, and the final write its typed rows. These staged
    rows are removed in the end. ``multi_line`` is for line breaks inside quotes.
    """
    staging = shared_folder(spark, "staging")
    texts = csv_files.csv_tables(spark, folder, keep_malformed=True, multi_line=multi_line)
    parsed = TableSet(
        {name: lambda n=name: parquet_files.staged(texts[n], f"{staging}/{n}") for name in texts}
    )
    try:
        return load_tables(parsed, root, mode, partitions=partitions)
    finally:
        parquet_files.remove(spark, staging)


def status_frame(spark: SparkSession, statuses: list[LoadStatus]) -> DataFrame:
    """One row per table, each with the share of all tables that loaded."""
    schema = "table_name string, ok boolean, row_count bigint, reason string"
    rows = spark.createDataFrame(
        [(s.table_name, s.ok, s.row_count, s.reason) for s in statuses], schema
    )
    return rows.withColumn("success_rate", F.lit(success_rate(statuses)))


def success_rate(statuses: list[LoadStatus]) -> str:
    return f"{100 * sum(s.ok for s in statuses) / len(statuses):.1f}%"


def write_report(
    spark: SparkSession, statuses: list[LoadStatus], root: str, report_path: str
) -> DataFrame:
    """Write one JSON record on the load: when, where to, per table, and how many."""
    loaded = sum(s.ok for s in statuses)
    report = spark.createDataFrame(
        [
            (
                dt.datetime.now(dt.timezone.utc).isoformat(),
                root,
                {s.table_name: s.ok for s in statuses},
                success_rate(statuses),
                f"Loaded {loaded} of {len(statuses)} tables",
            )
        ],
        "timestamp string, target string, tables map<string,boolean>, "
        "success_rate string, summary string",
    )
    report.coalesce(1).write.mode("overwrite").json(report_path)
    return report


def require_all(statuses: list[LoadStatus]) -> None:
    """Raise if any table was not loaded."""
    failed = [f"{s.table_name}: {s.reason}" for s in statuses if not s.ok]
    if failed:
        raise RuntimeError("not loaded: " + "; ".join(failed))
