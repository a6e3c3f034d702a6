"""``python -m tests.run_compare FOLDER [NAME...]``: compare queries with their SQL."""

import sys
import time

import __spark_entry__ as entry
from tests import comparing
from tillmetrics.session import build_session


def local_session(name: str, **conf: str):
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    }
    spark = build_session(name, "local[8]", **{**settings, **conf})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(folder: str, *names: str) -> int:
    spark = local_session("compare")
    con, queries, sql = comparing.connect(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        try:
            mine = comparing.spark_table(queries[name](spark, folder))
            took = time.time() - started
            if name not in sql:
                result = "no sql"
            else:
                result = comparing.difference(mine, comparing.duck_table(con, sql[name]))
        except Exception as e:  # noqa: BLE001 - report and go on
            mine, took, result = ([], []), time.time() - started, f"ERROR {str(e)[:600]}"
        bad += bool(result and result != "no sql")
        print(f"{name:34s} {len(mine[1]):7d} rows {took:6.2f}s {result or 'equal'}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
