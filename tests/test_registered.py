"""Every registered query against its SQL counterpart on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check
from cdcstrata.checks import oracle, registered

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, sql, name):
    df = registered.queries()[name](spark, FOLDER)
    found = sql.execute(oracle.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    assert check.rows(df.columns, [tuple(r) for r in df.collect()]) == check.rows(names, found.fetchall())


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracle.oracle_sql())
    assert set(registered.queries()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
