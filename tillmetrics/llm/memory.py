"""Memory of Python workers, which Spark keeps from task to task and stage to stage.

What a task has freed stays with its worker otherwise, beside the JVM's own, until the worker ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

ROWS_AT_ONCE = 1000  # handed to a Python worker; whole texts may be long

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def give_back() -> None:
    """Let the system have what is free in this process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def trimmed(batches: Iterator) -> Iterator:
    """``batches`` as they are; behind each, what it took is given back."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python by ROWS_AT_ONCE rows, unless the session has smaller batches."""
    now = int(spark.conf.get(_BATCH))
    if not 0 < now <= ROWS_AT_ONCE:
        spark.conf.set(_BATCH, str(ROWS_AT_ONCE))
