"""Every registered query against its SQL check in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_a_check():
    """Those without SQL are tested against brute force beside their operator."""
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    position = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in position) for row in found.fetchall()]
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    assert ordered(got) == ordered(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
