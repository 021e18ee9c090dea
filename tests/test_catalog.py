from __future__ import annotations

import pytest

from tests.oracle import TABLES, same
from tidegrid import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    same(QUERIES[name](spark, TABLES), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, TABLES).count() > 0


def test_flagship(spark):
    assert catalog.flagship(spark, TABLES).columns == ["reason", "n", "mean_s", "max_us"]
