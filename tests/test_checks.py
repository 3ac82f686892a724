"""Every check query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as checks
from quotemart.checks.oracle import ORACLE, sql
from quotemart.checks.queries import QUERIES
from tools.compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= checks.queries().keys() and checks.oracle_sql().keys() <= checks.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    done = duck.execute(sql(name))
    names = [c[0] for c in done.description]
    assert sorted(names) == sorted(df.columns)
    ours = rows_of(df.columns, df.collect())
    assert ours and ours == rows_of(names, done.fetchall())


def test_entry_is_the_fact(spark):
    df = checks.entry(spark)
    assert df.columns[:4] == ["date_key", "company_key", "industry_key", "exchange_key"]
    assert df.count() == 4256
