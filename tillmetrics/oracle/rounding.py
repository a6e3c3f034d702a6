"""Rounding half up in whole numbers: DuckDB's round of a DOUBLE misses ties such as 1.005."""

from __future__ import annotations


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def half_up(numerator: str, denominator: str, places: int = 2, times: int = 1) -> str:
    """``numerator * times / denominator`` of whole numbers, the denominator not negative."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    scaled = f"(2 * abs({n}) * {times * 10**places} + {d}) // NULLIF(2 * {d}, 0)"
    return f"CAST(sign({n}) * ({scaled}) AS DOUBLE) / {10**places}"


def amount_per(amount: str, count: str) -> str:
    return half_up(cents(amount), f"100 * ({count})")
