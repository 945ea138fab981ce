"""Every registered query gives what its SQL gives on the same tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from check_queries import TABLES, compare
from loreweave.catalog import CHECKS, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    ok, note, _, _ = compare(spark, con, sf, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)


def test_entry(spark):
    assert entry(spark).count() > 0
