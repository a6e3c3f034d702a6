"""Records cut by many tasks against the reader that takes a file in one."""

import random

import pytest

from tillmetrics.schemas import ORDER_ITEMS
from tillmetrics.sources import csv_files, csv_records

OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def field(r):
    kind = r.random()
    text = "".join(r.choices(["a", "b", " ", "é", ",", '""', "\n", "\n\n", "\r\n"], k=r.randint(0, 6)))
    if kind < 0.5:
        return f'"{text}"'
    plain = "".join(r.choices(["x", "yz", " ", "1"], k=r.randint(0, 4)))
    return plain + '"q' if kind < 0.6 and plain.strip() else plain


def write(path, seed, rows, end="\n"):
    r = random.Random(seed)
    lines = [",".join(["c", "d", "e"])] + [",".join([f"v{i}", field(r), field(r)]) for i in range(rows)]
    path.write_bytes((end.join(lines) + end).encode())


def single_task(spark, path):
    df = spark.read.options(**OPTIONS).schema("c string, d string, e string").csv(str(path))
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def tiny_splits(spark):
    """Splits of some hundred bytes, several to a partition."""
    settings = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "0"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n"), (4, "\n")])
def test_rows_are_those_of_the_single_task_reader(spark, tmp_path, tiny_splits, seed, end):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", seed, 150, end)
    write(folder / "b.csv", seed + 100, 40, end)
    names, found = csv_records.with_header(csv_records.records(spark, str(folder)))
    assert names == ["c", "d", "e"]
    raw, present = csv_files._quoted_lines(spark, str(folder))
    assert present == {"c", "d", "e"}
    rows = [tuple(r) for r in raw.select("c", "d", "e").collect()]
    if end == "\r\n":  # the other reader turns these into "\n" within fields, too, in such files only
        rows = [tuple(v and v.replace("\r\n", "\n") for v in r) for r in rows]
    assert sorted(rows, key=repr) == single_task(spark, folder)


def test_many_tasks_read_one_file(spark, tmp_path, tiny_splits):
    write(tmp_path / "a.csv", 5, 400)
    lines = csv_records._lines(spark, str(tmp_path / "a.csv"))
    assert lines.rdd.getNumPartitions() > 20
    starts = lines.select("start").distinct().count()
    assert starts > 20
    quoted = csv_records._beginning_quoted(lines.mapInArrow(csv_records._split_ends, csv_records._ENDS_DDL))
    assert 0 < quoted.count() < starts


def test_many_splits_that_begin_quoted_are_joined(spark, tmp_path, tiny_splits, monkeypatch):
    write(tmp_path / "a.csv", 6, 300)
    monkeypatch.setattr(csv_records, "SPLITS_SENT", 0)
    raw, _ = csv_files._quoted_lines(spark, str(tmp_path / "a.csv"))
    assert sorted(map(tuple, raw.select("c", "d", "e").collect()), key=repr) == single_task(spark, tmp_path / "a.csv")


def test_a_field_over_many_splits_and_one_that_never_ends(spark, tmp_path, tiny_splits):
    long = "\n".join(f"line {i}" for i in range(400))
    (tmp_path / "a.csv").write_text(f'c,d,e\n1,"{long}",2\n3,4,5\n6,"open\nto the\nend')
    raw, _ = csv_files._quoted_lines(spark, str(tmp_path / "a.csv"))
    found = sorted(map(tuple, raw.select("c", "d", "e").collect()), key=repr)
    assert found[:2] == [("1", long, "2"), ("3", "4", "5")]
    assert found[2][:2] == ("6", "open\nto the\nend")


def test_malformed_rows_differing_headers_and_empty_files(spark, tmp_path):
    header = "order_item_id,order_id,product_id,quantity,unit_price,subtotal\n"
    (tmp_path / "a.csv").write_text(header + '1,1,1,1,2.5,2.5\n2,1,1,1,2.5,2.5,9\n3,1\n\n4,1,1,"1",x,2.5\n')
    df = csv_files.read_csv(spark, str(tmp_path / "a.csv"), ORDER_ITEMS, keep_malformed=True, multi_line=True)
    found = {r["order_item_id"]: r[csv_files.MALFORMED] for r in df.collect()}
    assert found == {1: 0, 2: 1, 3: 1, 4: 1}
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n1,2\n")
    (folder / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="headers differ"):
        csv_files.read_csv(spark, str(folder), ORDER_ITEMS, multi_line=True)
    (tmp_path / "e.csv").write_text("")
    assert csv_files.read_csv(spark, str(tmp_path / "e.csv"), ORDER_ITEMS, True, True).collect() == []


def test_ends_quoted():
    assert not csv_records.ends_quoted("a,b", False) and csv_records.ends_quoted("a,b", True)
    assert csv_records.ends_quoted('"a', False) and csv_records.ends_quoted('x,"a', False)
    assert not csv_records.ends_quoted('a"b', False) and csv_records.ends_quoted('"a""', False)
    assert not csv_records.ends_quoted('a",b', True) and csv_records.ends_quoted('a","b', True)
