"""Queries of this package against their SQL."""

import duckdb
import pytest

from farebox.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    result = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = connection.execute(
        f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})"
    ).fetchall()
    found = [tuple(row) for row in result.select(*columns).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert found
