"""Money and ratios.

Money is stored as DECIMAL(18,2). Summing that type widens to 28 digits, which
Spark adds as BigDecimal objects; sums here run on whole cents in a BIGINT, which
is exact and several times faster. A group may total up to 9.2e16 before ANSI
mode raises an overflow error. Amounts become DOUBLE only in report output.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column | str) -> Column:
    """A DECIMAL(18,2) amount as whole cents."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return (c.cast("decimal(18,2)") * 100).cast("bigint")


def sum_cents(amount: Column | str) -> Column:
    return F.sum(cents(amount))


def to_amount(cent_count: Column | str) -> Column:
    """Whole cents as a DOUBLE amount, correctly rounded."""
    c = F.col(cent_count) if isinstance(cent_count, str) else cent_count
    return (c.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Real division; NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded_ratio(
    numerator: Column, denominator: Column, places: int = 2, times: int = 1
) -> Column:
    """``numerator * times / denominator`` of whole numbers, rounded half up.

    The quotient is a decimal: as a DOUBLE, 20908509.65 / 14 = 1493464.975 is
    slightly too small and would round down. NULL when the denominator is zero.
    """
    whole = numerator.cast("decimal(20,0)") * times
    quotient = F.try_divide(whole, denominator.cast("decimal(20,0)"))
    return F.round(quotient, places).cast("double")


def rounded_percent(part: Column, whole: Column, places: int = 2) -> Column:
    return rounded_ratio(part, whole, places, times=100)


def rounded_amount(cent_count: Column, divisor: Column, places: int = 2) -> Column:
    """Cents over a count, as an amount."""
    return rounded_ratio(cent_count, divisor * 100, places)


def whole_division(numerator: Column, denominator: Column) -> Column:
    """Integer division that truncates; NULL when the denominator is zero or NULL."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0)))


def clamp(value: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
