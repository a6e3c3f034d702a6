"""Files that lookups by indexed columns open, and the curve that rows are stored along."""

import random

import pytest
from pyspark.sql import functions as F

from tests.shop import frame
from tillmetrics.schemas import CUSTOMERS, ORDERS, TABLES
from tillmetrics.sources import access, parquet_files

# The predicates of the eleven indexes: table, column.
INDEXES = [
    ("customers", "email"), ("customers", "country"), ("customers", "customer_tier"),
    ("orders", "customer_id"), ("orders", "status"), ("orders", "order_date"),
    ("order_items", "order_id"), ("order_items", "product_id"),
    ("payments", "order_id"), ("payments", "payment_status"), ("payments", "payment_date"),
]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """3000 rows a table with values independent of each other, in two months, 32 files or so."""
    folder = str(tmp_path_factory.mktemp("access"))
    for name, table in TABLES.items():
        columns = []
        for f in table.schema.fields:
            part = f"pmod(xxhash64(id, '{f.name}'), 1000)"
            kind = f.dataType.simpleString()
            if f.name == table.primary_key:
                text = "id"
            elif f.name in table.domains:
                values = ", ".join(f"'{v}'" for v in table.domains[f.name])
                text = f"element_at(array({values}), CAST({part} % {len(table.domains[f.name])} AS int) + 1)"
            elif kind == "timestamp_ntz":
                text = f"TIMESTAMP_NTZ'2023-01-01' + make_interval(0, 0, 0, 0, CAST({part} AS int))"
            elif kind == "date":
                text = f"DATE'2023-01-01' + CAST({part} AS int)"
            elif kind == "boolean":
                text = f"{part} < 500"
            elif kind == "string":
                text = f"concat(chr(CAST(97 + {part} % 26 AS int)), '{f.name}', {part})"
            else:
                text = part
            columns.append(f"CAST({text} AS {kind}) AS {f.name}")
        parquet_files.write_table(spark.range(3000).selectExpr(*columns), folder, table, partitions=32)
    return folder


@pytest.mark.parametrize("name, column", INDEXES)
def test_lookups_open_few_files_and_find_every_row(spark, root, name, column):
    table = TABLES[name]
    whole = parquet_files.read_table(spark, root, table)
    files = len(whole.inputFiles())
    values = [r[0] for r in whole.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column).collect()]
    value = values[len(values) // 2]
    found = parquet_files.look_up(spark, root, table, column, value)
    expected = whole.filter(F.col(column) == F.lit(value))
    assert sorted(found.collect(), key=repr) == sorted(expected.collect(), key=repr)
    ranges = access.file_ranges(spark, root, table, parquet_files.version(spark, root, table).parts)
    opened = access.files_with(ranges, column, value, value).count()
    assert ranges.count() == files and opened == len(found.inputFiles())
    distinct = len(values)
    assert files > 25 and opened <= 0.7 * files, (distinct, opened, files)


def test_a_range_and_a_value_that_is_nowhere(spark, root):
    whole = parquet_files.read_table(spark, root, ORDERS)
    low, high = [r[0] for r in whole.select("customer_id").distinct().orderBy("customer_id").collect()][2:9:6]
    found = parquet_files.look_up(spark, root, ORDERS, "customer_id", low, high)
    assert found.count() == whole.filter(F.col("customer_id").between(low, high)).count()
    assert parquet_files.look_up(spark, root, ORDERS, "customer_id", -5).collect() == []
    with pytest.raises(FileNotFoundError):
        parquet_files.look_up(spark, f"{root}/nowhere", ORDERS, "customer_id", 1)


def test_places_interleave_the_bits_of_ranks(spark):
    df = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "a bigint, b bigint")
    known = {"a": list(range(1, 8)), "b": list(range(1, 8))}
    for r in df.withColumn("p", access.curve_place(df, known)).collect():
        a, b = 8 * r["a"], 8 * r["b"]  # eight ranks spread over six bits
        expected = sum(((a >> i) & 1) << (2 * i) | ((b >> i) & 1) << (2 * i + 1) for i in range(6))
        assert r["p"] == expected


def test_texts_dates_and_nulls_have_places(spark):
    r = random.Random(2)
    rows = [{"country": r.choice(["Peru", "Österreich", "", "日本"]), "email": f"{i}@x"} for i in range(50)]
    df = frame(spark, "customers", rows).withColumn("country", F.expr("IF(customer_id % 9 = 0, NULL, country)"))
    known = access.borders(df, access.INDEXED["customers"])
    placed = df.withColumn("p", access.curve_place(df, known))
    assert placed.filter("p IS NULL OR p < 0").count() == 0
    empty = df.limit(0)
    known = access.borders(empty, access.INDEXED["customers"])
    assert empty.withColumn("p", access.curve_place(empty, known)).collect() == []
    dated = spark.createDataFrame([(None,)], "order_date timestamp_ntz")
    assert access.borders(dated, ("order_date",)) == {"order_date": []}
    assert CUSTOMERS.name in access.INDEXED


def test_places_are_found_without_lambdas(spark):
    df = spark.range(500).selectExpr("IF(id % 7 = 0, NULL, id * 37 % 211) AS a", "id AS b")
    known = access.borders(df, ("a", "b"))
    placed = df.withColumn("p", access.curve_place(df, known))
    assert "lambda" not in placed._jdf.queryExecution().toString()  # not compiled, run for each border
    for r in placed.collect():
        expected = 0
        for i, c in enumerate(("a", "b")):
            reached = 0 if r[c] is None else sum(v <= r[c] for v in known[c])
            rank = reached * 64 // (len(known[c]) + 1)
            expected += sum((rank >> bit & 1) << (2 * bit + i) for bit in range(6))
        assert r["p"] == expected
