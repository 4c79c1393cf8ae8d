"""Every named query against its SQL on the same tables."""

import os

import duckdb
import pytest

from tripmill.catalog import QUERIES
from tripmill.oracle import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sql, name):
    ours = QUERIES[name](spark, SF_DIR)
    names = sorted(ours.columns)
    theirs = sql.sql(ORACLES[name])
    assert sorted(theirs.columns) == names
    expected = sql.sql(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(row) for row in ours.select(*names).collect()]
    assert ordered(got) == ordered(expected)


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLES)
