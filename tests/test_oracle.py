"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from tests import comparing
from tillmetrics import oracle, registry

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.all_queries()
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    con = comparing.connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    mine = comparing.spark_table(QUERIES[name](spark, FOLDER))
    assert mine[1], "no rows"
    assert comparing.difference(mine, comparing.duck_table(duck, SQL[name])) == ""


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert {r.customer_segment for r in entry.entry(spark).collect()} == {"VIP", "Regular", "New"}
