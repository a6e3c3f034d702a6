"""The reports. Each takes the tables by name and returns a DataFrame.

``mode="reference"`` keeps a report's customary definition; ``mode="corrected"``
repairs it where that definition is questionable, as each report says.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

Tables = Mapping[str, DataFrame]

REFERENCE = "reference"
CORRECTED = "corrected"


def is_corrected(mode: str) -> bool:
    if mode not in (REFERENCE, CORRECTED):
        raise ValueError(f"mode must be {REFERENCE!r} or {CORRECTED!r}, not {mode!r}")
    return mode == CORRECTED
