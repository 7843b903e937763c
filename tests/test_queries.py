"""Every registered query against its SQL, on the driver's tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# DuckDB type names by Spark type name, for the types in use.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    yield connection
    connection.close()


def _expected_type(name):
    return TYPES.get(name) or name.upper()


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


# Queries of the package for training text have tests of their own beside it.
OWN = [name for name in sorted(entry.queries()) if not re.match(r"op\d+_|pipeline$", name)]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, oracle, name):
    result = entry.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    sql = f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})"
    described = oracle.execute(f"DESCRIBE {sql}").fetchall()
    kinds = dict(result.dtypes)
    assert [(c, _expected_type(kinds[c])) for c in columns] == [
        (c, kind.replace(" ", "")) for c, kind, *_ in described
    ]
    expected = oracle.execute(sql).fetchall()
    actual = [tuple(row) for row in result.select(*columns).collect()]
    assert len(actual) == len(expected) > 0
    assert _sorted(actual) == _sorted(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
