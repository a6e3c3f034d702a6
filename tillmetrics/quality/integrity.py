"""The integrity of the five tables together: references and sound values."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillmetrics.plans import Tables
from tillmetrics.quality import stack
from tillmetrics.quality.keys import check_references
from tillmetrics.quality.rows import count_violations, integrity_ranges


def check_integrity(tables: Tables) -> DataFrame:
    ranges = [
        count_violations(tables[name], name, integrity_ranges(tables[name]))
        for name in ("products", "order_items")
    ]
    return stack([check_references(tables), *ranges])


def require_integrity(tables: Tables) -> None:
    """Raise if any reference is lost or any value unsound."""
    failed = check_integrity(tables).filter("NOT passed").collect()  # seven checks
    if failed:
        found = [f"{c.table_name}.{c.column_name} {c.check_name}: {c.violations}" for c in failed]
        raise ValueError("; ".join(sorted(found)))
