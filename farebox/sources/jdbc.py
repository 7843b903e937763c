"""Database tables over JDBC, read in parallel and written to named targets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Where a database is; the caller supplies address and credentials."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Slices:
    """How to split a table scan: ranges of a numeric, date or timestamp column.

    The bounds only place the cuts. Rows outside them, and rows where the column
    is null, belong to the first or last slice, so no row is lost.
    """

    column: str
    lower: int | str
    upper: int | str
    count: int


def target(targets: dict[str, JdbcTarget], name: str) -> JdbcTarget:
    if name not in targets:
        raise ValueError(f"Unknown target: {name}")
    return targets[name]


def read_options(
    database: JdbcTarget, table: str, slices: Slices | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    options = {
        **database.properties,
        "url": database.url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
    }
    if slices is not None:
        options |= {
            "partitionColumn": slices.column,
            "lowerBound": str(slices.lower),
            "upperBound": str(slices.upper),
            "numPartitions": str(slices.count),
        }
    return options


def write_options(
    database: JdbcTarget, table: str, connections: int = 16, batch_size: int = 10_000
) -> dict[str, str]:
    return {
        **database.properties,
        "url": database.url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        # Overwriting empties the table rather than dropping it, so that the
        # column types, keys and defaults of the database survive.
        "truncate": "true",
    }


def read_jdbc(
    spark: SparkSession, database: JdbcTarget, table: str, slices: Slices | None = None
) -> DataFrame:
    """Scan a database table; without ``slices`` over a single connection."""
    return spark.read.format("jdbc").options(**read_options(database, table, slices)).load()


def write_jdbc(
    df: DataFrame,
    targets: dict[str, JdbcTarget],
    name: str,
    table: str,
    mode: str = "append",
    connections: int = 16,
) -> None:
    """Write ``df`` to ``table`` of the target called ``name``.

    Rows are dealt out to the connections by a shuffle, so that their number does not
    limit the tasks that compute ``df``.
    """
    options = write_options(target(targets, name), table, connections)
    df.repartition(connections).write.format("jdbc").options(**options).mode(mode).save()
