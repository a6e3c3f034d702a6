"""CSV records with line breaks inside quotes, cut from files by many tasks.

Whether a line break ends a record depends on the quotes before it, back to the start of the
file. Each split of a file is therefore read twice. First it tells how it would end, in a
quoted field or not, if it began outside of one, and if it began inside. A running
composition of these answers over a file's splits, a row each, says how each really
begins. Then each split gives its whole records, and the pieces of records that cross its
borders; these few are put together by the order of their splits.

A quote opens a field only as its first character, and ends it unless it is doubled; behind the
closing quote the field goes on to the next comma or line break. Elsewhere quotes are text.
Line breaks within a field stay as they are in the file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLITS_SENT = 100_000  # that begin within quotes and are sent to all tasks; more are joined
ROWS_AT_ONCE = 4096

_ENDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("out", pa.bool_()), ("within", pa.bool_())])
_PIECES = pa.schema(
    [
        ("file", pa.string()),
        ("start", pa.int64()),
        ("place", pa.int64()),
        ("opens", pa.bool_()),
        ("closes", pa.bool_()),
        ("text", pa.string()),
    ]
)
_ENDS_DDL = "file string, start bigint, out boolean, within boolean"
_PIECES_DDL = "file string, start bigint, place bigint, opens boolean, closes boolean, text string"


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether the text behind ``line`` is in a quoted field, if it began in one or at a record's start."""
    if '"' not in line:
        return quoted
    at = 0
    while True:
        if not quoted:
            if line.startswith('"', at):
                at += 1
            else:
                comma = line.find(",", at)
                if comma < 0:
                    return False
                at = comma + 1
                continue
        quote = line.find('"', at)
        while quote >= 0 and line.startswith('"', quote + 1):
            quote = line.find('"', quote + 2)
        if quote < 0:
            return True
        comma = line.find(",", quote + 1)
        if comma < 0:
            return False
        at, quoted = comma + 1, False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    # "\n" alone ends a line, so that "\r" stays where it stands in a quoted field.
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def _split_ends(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each split ends, for both ways it may begin."""
    now, out, within = None, False, True
    for table in tables:
        for line, file, start in zip(*(table[c].to_pylist() for c in ("value", "file", "start"))):
            if (file, start) != now:
                if now:
                    yield pa.RecordBatch.from_pylist([dict(zip(_ENDS.names, (*now, out, within)))], _ENDS)
                now, out, within = (file, start), False, True
            out, within = ends_quoted(line, out), ends_quoted(line, within)
    if now:
        yield pa.RecordBatch.from_pylist([dict(zip(_ENDS.names, (*now, out, within)))], _ENDS)


def _beginning_quoted(ends: DataFrame) -> DataFrame:
    """The splits (file, start) that begin in a quoted field.

    A split that ends alike however it began settles what comes behind it; one that ends the other
    way round swaps it; the rest pass it on.
    """
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col("out") == F.col("within")
    run = ends.withColumn("run", F.coalesce(F.sum(settles.cast("int")).over(before), F.lit(0)))
    run = run.withColumn("settled", F.coalesce(F.last(F.when(settles, F.col("out")), True).over(before), F.lit(False)))
    in_run = Window.partitionBy("file", "run").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    swapped = F.coalesce(F.sum((F.col("out") & ~F.col("within")).cast("int")).over(in_run), F.lit(0)) % 2 == 1
    # What settled the run is the row in front of it, so only swaps within the run count.
    return run.withColumn("quoted", F.col("settled") != swapped).filter("quoted").select("file", "start")


def _split_pieces(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split, and what it holds of records that began or end in another one."""
    now, quoted, opens, place = None, False, True, 0
    lines: list[str] = []
    rows: list[tuple] = []

    def done(closes: bool) -> None:
        nonlocal opens, place
        rows.append((*now, place, opens, closes, "\n".join(lines)))
        lines.clear()
        opens, place = True, place + 1

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist([dict(zip(_PIECES.names, r)) for r in rows], _PIECES)
        rows.clear()
        return batch

    for table in tables:
        columns = [table[c].to_pylist() for c in ("value", "file", "start", "quoted")]
        for line, file, start, begins_quoted in zip(*columns):
            if (file, start) != now:
                if lines:
                    done(False)
                now, quoted, opens, place = (file, start), begins_quoted, not begins_quoted, 0
            lines.append(line)
            quoted = ends_quoted(line, quoted)
            if not quoted:
                done(True)
            if len(rows) >= ROWS_AT_ONCE:
                yield out()
    if lines:
        done(False)
    yield out()


def _marked(lines: DataFrame, quoted: DataFrame) -> DataFrame:
    """Lines in their order within each split, with whether the split begins in a quoted field."""
    quoted = quoted.withColumn("quoted", F.lit(True))
    if quoted.limit(SPLITS_SENT + 1).count() <= SPLITS_SENT:
        marked = lines.join(F.broadcast(quoted), ["file", "start"], "left")  # keeps the lines' order
    else:
        placed = lines.withColumn("n", F.monotonically_increasing_id()).join(quoted, ["file", "start"], "left")
        marked = placed.repartition("file", "start").sortWithinPartitions("file", "start", "n")
    return marked.select("value", "file", "start", F.coalesce("quoted", F.lit(False)).alias("quoted"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, place, text) of every record; ``start`` and ``place`` give the order in its file."""
    lines = _lines(spark, path)
    quoted = _beginning_quoted(lines.mapInArrow(_split_ends, _ENDS_DDL))
    pieces = _marked(lines, quoted).mapInArrow(_split_pieces, _PIECES_DDL)
    whole = pieces.filter("opens AND closes").select("file", "start", "place", "text")
    # At most two pieces a split: the end of a record from before and the start of one that goes on.
    order = Window.partitionBy("file").orderBy("start", "place")
    crossing = pieces.filter("NOT (opens AND closes)").withColumn("record", F.sum(F.col("opens").cast("int")).over(order))
    piece = F.struct("start", "place", "text")
    joined = crossing.groupBy("file", "record").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    joined = joined.select(
        "file",
        F.col("pieces")[0]["start"].alias("start"),
        F.col("pieces")[0]["place"].alias("place"),
        F.array_join("pieces.text", "\n").alias("text"),
    )
    found = whole.unionByName(joined)
    return found.withColumn("text", F.regexp_replace("text", r"\r$", "")).filter("text <> ''")


def with_header(found: DataFrame) -> tuple[list[str], DataFrame]:
    """Column names, and the records without the files' first ones, which must all be alike."""
    first = found.filter("start = 0 AND place = 0")
    headers = [r["text"] for r in first.select("text").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError("the files' headers differ")
    if not headers:
        return [], found
    names = next(csv.reader([headers[0].removeprefix("﻿")]))
    return [n or f"_c{i}" for i, n in enumerate(names)], found.filter("NOT (start = 0 AND place = 0)")
