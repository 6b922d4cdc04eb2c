"""Every registered query against DuckDB, at the smallest scale."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.oracle import ORACLE
from checks.queries import REGISTERED
from conftest import TESTDATA

SF = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in TESTDATA.joinpath("sf0.001").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(REGISTERED) == set(ORACLE)
    assert set(REGISTERED) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_sql(spark, database, name):
    found = queries()[name](spark, SF)
    cursor = database.execute(oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(found.columns) == sorted(names)
    ours = [tuple(row) for row in found.select(*names).collect()]
    assert ours, "a query without rows shows nothing"
    assert sorted(ours, key=repr) == sorted(cursor.fetchall(), key=repr)
