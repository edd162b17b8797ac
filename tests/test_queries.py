"""Every registered query at the smallest scale, beside its SQL."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    said, _, ok = compare(spark, con, name, queries()[name], oracle_sql().get(name), SF)
    assert ok, said


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
