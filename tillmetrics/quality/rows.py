"""Checks that look at one row at a time; all those of a table share one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.plans import Tables
from tillmetrics.quality import CHECK_COLUMNS, check_row, stack, unfold
from tillmetrics.schemas import TABLES, Table


@dataclass(frozen=True)
class Rule:
    check: str
    column: str
    violated: str  # a row for which this is NULL keeps the rule


def critical_nulls(table: Table) -> list[Rule]:
    return [Rule("null", c, f"{c} IS NULL") for c in table.critical]


# Bounds a table must keep to be loaded, and the stricter ones of sound data.
LOAD_BOUNDS = {"quantity": "quantity <= 0", "price": "price < 0"}
INTEGRITY_BOUNDS = {
    "quantity": "quantity <= 0",
    "price": "price <= 0",
    "unit_price": "unit_price < 0",
}


def load_ranges(df: DataFrame) -> list[Rule]:
    return [Rule("range", c, v) for c, v in LOAD_BOUNDS.items() if c in df.columns]


def integrity_ranges(df: DataFrame) -> list[Rule]:
    return [Rule("integrity_range", c, v) for c, v in INTEGRITY_BOUNDS.items() if c in df.columns]


def declared(table: Table) -> list[Rule]:
    """Declared NOT NULL and length limits."""
    required = [Rule("required", c, f"{c} IS NULL") for c in table.required]
    return required + [Rule("length", c, f"length({c}) > {n}") for c, n in table.max_length.items()]


def domains(table: Table) -> list[Rule]:
    return [
        Rule("domain", c, f"{c} NOT IN ({', '.join(repr(v) for v in values)})")
        for c, values in table.domains.items()
    ]


def count_violations(df: DataFrame, table_name: str, rules: list[Rule]) -> DataFrame:
    """One scan, one row per task to the shuffle, whatever the number of rules."""
    counts = df.selectExpr(*[f"count_if({r.violated}) AS rule_{i}" for i, r in enumerate(rules)])
    found = [check_row(table_name, r.check, r.column, f"rule_{i}") for i, r in enumerate(rules)]
    return unfold(counts, found, CHECK_COLUMNS)


def violating_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows that break a rule, with the names of the rules they break."""
    names = [f"IF({r.violated}, '{r.check}:{r.column}', NULL)" for r in rules]
    broken = F.expr(f"array_compact(array({', '.join(names)}))")
    return df.withColumn("violated_rules", broken).filter("size(violated_rules) > 0")


def _each(tables: Tables, rules_of) -> DataFrame:
    frames = []
    for name, table in TABLES.items():
        rules = rules_of(table, tables[name])
        if rules:
            frames.append(count_violations(tables[name], name, rules))
    return stack(frames)


def check_nulls(tables: Tables) -> DataFrame:
    return _each(tables, lambda table, df: critical_nulls(table))


def check_ranges(tables: Tables) -> DataFrame:
    return _each(tables, lambda table, df: load_ranges(df) + integrity_ranges(df))


def check_declared(tables: Tables) -> DataFrame:
    return _each(tables, lambda table, df: declared(table))


def check_domains(tables: Tables) -> DataFrame:
    return _each(tables, lambda table, df: domains(table))


def check_lines(tables: Tables) -> DataFrame:
    """Line amounts against quantity times unit price.

    A unit price rounded to a cent may move the product by a cent per unit.
    """
    rules = [
        Rule("exact_line_amount", "subtotal", "subtotal <> quantity * unit_price"),
        Rule(
            "line_amount", "subtotal", "abs(subtotal - quantity * unit_price) > quantity * 0.01"
        ),
    ]
    return count_violations(tables["order_items"], "order_items", rules)
