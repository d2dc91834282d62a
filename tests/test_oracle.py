"""Every query against its SQL on the same tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(rows):
    return sorted(
        (tuple(str(v) if isinstance(v, Decimal) else v for v in row) for row in rows), key=repr
    )


def test_every_query_of_the_library_has_sql():
    from queries.results import QUERIES

    assert set(SQL) <= set(driver.queries())
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    columns = sorted(df.columns)
    expected = duck.sql(SQL[name])
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    for column, dtype in df.dtypes:
        assert types[column] == TYPES.get(dtype, dtype.upper()), column
    rows = duck.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    found = plain(df.select(*columns).collect())
    assert len(found) == len(rows)
    assert found == plain(rows)
