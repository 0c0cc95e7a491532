"""Every registered query against its SQL, on the smallest of the driver's tables."""

from pathlib import Path

import pytest
from check_oracle import connect, rows_of, rows_of_sql

import __spark_entry__ as contract
from shelfstream.registry import ORACLE_SQL, QUERIES

TABLES = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(TABLES).exists(), reason="no driver tables")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    columns, got = rows_of(QUERIES[name](spark, TABLES))
    want_columns, want = rows_of_sql(connect(TABLES), ORACLE_SQL[name])
    assert columns == want_columns
    assert got == want
    assert got.total() > 0


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
