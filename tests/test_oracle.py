"""Every registered query against its SQL in DuckDB, on the smallest data set."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.queries import QUERIES as OWN

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES = {name: query for name, query in contract.queries().items() if name in OWN}
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return None if value != value else round(float(value), 9)
    return str(value) if hasattr(value, "isoformat") else value


def ordered(rows, positions):
    picked = [tuple(plain(row[p]) for p in positions) for row in rows]
    return sorted(picked, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(OWN) <= set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLE[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    got = ordered(result.collect(), columns)
    want = ordered(expected.fetchall(), [expected.columns.index(c) for c in columns])
    assert got, "no rows"
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).count() == 259
