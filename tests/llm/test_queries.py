"""Queries that SQL can express, against their SQL over whole tables."""

import pytest

from tests import comparing
from tillmetrics.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    con = comparing.connect(FOLDER)
    mine = comparing.spark_table(QUERIES[name](spark, FOLDER))
    assert mine[1], "no rows"
    assert comparing.difference(mine, comparing.duck_table(con, ORACLE_SQL[name])) == ""
    con.close()
