"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the reports are written for. All are per session, none needs a restart.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # overflow fails the job instead of wrapping
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the source line of every column expression triples the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "tillmetrics",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings above.

    ``shuffle_bytes`` is about the most that one shuffle moves; the reports
    shuffle few columns, a tenth of their input or less.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes))
        # Scans read few columns of a split, so larger splits give tasks of a useful size.
        settings["spark.sql.files.maxPartitionBytes"] = "512m"
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(
    shuffle_bytes: int, partition_bytes: int = 256 * 1024**2, minimum: int = 8
) -> int:
    """Partitions that keep each reduce task near ``partition_bytes``.

    Adaptive execution merges partitions that turn out small, so an estimate on
    the high side costs little while one on the low side makes tasks spill.
    """
    return max(minimum, math.ceil(shuffle_bytes / partition_bytes))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder all executors can reach, under ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tillmetrics-")
    return f"{base.rstrip('/')}/tillmetrics/{purpose}-{uuid.uuid4().hex}"
