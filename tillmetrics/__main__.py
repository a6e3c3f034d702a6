"""``spark-submit`` entry: CSV folder, table root, report folder, and the day of the key figures."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from tillmetrics import pipeline
from tillmetrics.session import build_session


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillmetrics")
    parser.add_argument("csv_folder")
    parser.add_argument("root")
    parser.add_argument("report_folder")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    parser.add_argument("--append", action="store_true")
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quotes")
    parser.add_argument("--shuffle-bytes", type=int, default=None)
    given = parser.parse_args(arguments)
    spark = build_session(shuffle_bytes=given.shuffle_bytes)
    as_of = given.as_of or dt.datetime.now(dt.timezone.utc).date()
    mode = "append" if given.append else "overwrite"
    try:
        pipeline.run(
            spark,
            given.csv_folder,
            given.root,
            given.report_folder,
            as_of,
            mode,
            given.multi_line,
        )
    except RuntimeError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
