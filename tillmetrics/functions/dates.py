"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: Column, end: Column) -> Column:
    """Elapsed days with their fraction: 36 hours give 1.5."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return seconds.cast("double") / F.lit(86400.0)


def year_month(moment: Column | str) -> Column:
    return F.date_format(moment, "yyyy-MM")


def days_before(as_of: dt.date, days: int) -> Column:
    return F.date_sub(F.lit(as_of), days)


def hours_after(moment: Column, hours: int) -> Column:
    return moment + F.lit(dt.timedelta(hours=hours))
