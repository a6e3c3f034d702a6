"""From CSV files to written reports."""

import datetime as dt
import json
from pathlib import Path

import pytest

from tests.shop import rows
from tests.test_random import random_shop
from tillmetrics import pipeline
from tillmetrics.schemas import TABLES
from tillmetrics.sources import csv_files


@pytest.fixture
def folder(spark, tmp_path):
    """CSV files without the NULLs that loading refuses."""
    shop = random_shop(spark, 5, n_orders=60)
    for name, table in TABLES.items():
        clean = shop[name].dropna(subset=table.required)
        if name == "order_items":
            clean = clean.filter("quantity > 0")
        csv_files.write_csv(clean, f"{tmp_path}/in/{name}.csv")
    return tmp_path


def test_run_writes_all_reports(spark, folder):
    statuses = pipeline.run(
        spark, f"{folder}/in", f"{folder}/db", f"{folder}/out", dt.date(2001, 8, 1)
    )
    assert [s.reason for s in statuses] == [""] * 5
    found = {p.name for p in Path(folder, "out").iterdir()}
    assert len(found) == 13 and {"load", "schema", "integrity", "kpi_dashboard", "tier_summary"} <= found
    lost = spark.read.parquet(f"{folder}/out/integrity").filter("check_name = 'reference'")
    assert lost.count() == 4 and lost.filter("NOT passed").count() > 0  # the files hold orphans
    best = spark.read.parquet(f"{folder}/out/top_products")
    assert best.count() == 5
    (part,) = Path(folder, "out", "schema").glob("part-*.json")
    tables = {t["table_name"]: t for t in map(json.loads, part.read_text().splitlines())}
    assert [c["column_name"] for c in tables["payments"]["columns"]] == TABLES["payments"].columns
    assert tables["customers"]["row_count"] == statuses[0].row_count


def test_run_stops_after_the_load_report(spark, folder):
    (folder / "in" / "payments.csv").rename(folder / "in" / "elsewhere.csv")
    with pytest.raises(RuntimeError, match="payments: missing file"):
        pipeline.run(spark, f"{folder}/in", f"{folder}/db", f"{folder}/out", dt.date(2001, 8, 1))
    assert {p.name for p in Path(folder, "out").iterdir()} == {"load"}
    report = spark.read.json(f"{folder}/out/load")
    assert rows(report)[0]["success_rate"] == "80.0%"
