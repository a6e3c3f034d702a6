"""``python -m tests.task_balance FOLDER LOG_FOLDER NAME...``: rows per task of each shuffle.

Runs the queries without broadcasts and with skew thresholds scaled down to test
sizes, and reads Spark's event log: in every stage the largest task should read a
small multiple of the median, also when one key has a third of all rows.
"""

import json
import sys
from collections import defaultdict
from pathlib import Path

import __spark_entry__ as entry
from tests.run_compare import local_session

LEAST_ROWS = 200_000  # smaller stages are not shown


def run(folder: str, log_folder: str, names: list[str]) -> None:
    spark = local_session(
        "task balance",
        **{
            "spark.sql.shuffle.partitions": "64",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4m",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file:{log_folder}",
            "spark.eventLog.compress": "false",
        },
    )
    for name in names:
        spark.sparkContext.setJobDescription(name)
        entry.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
    spark.stop()


def report(log_folder: str) -> None:
    query_of, rows = {}, defaultdict(list)
    for path in sorted(p for p in Path(log_folder).rglob("events*") if p.is_file()):
        for event in map(json.loads, path.read_text().splitlines()):
            if event["Event"] == "SparkListenerJobStart":
                name = event["Properties"].get("spark.job.description", "")
                query_of.update((stage, name) for stage in event["Stage IDs"])
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                rows[event["Stage ID"]].append(read)
    print(f"{'query':34s} {'stage':>5s} {'tasks':>5s} {'rows':>10s} {'largest':>9s} {'median':>9s}")
    for stage, read in sorted(rows.items()):
        if sum(read) >= LEAST_ROWS:
            median = sorted(read)[len(read) // 2]
            print(
                f"{query_of.get(stage, ''):34s} {stage:5d} {len(read):5d} {sum(read):10d} "
                f"{max(read):9d} {median:9d}"
            )


if __name__ == "__main__":
    run(sys.argv[1], sys.argv[2], sys.argv[3:])
    report(sys.argv[2])
