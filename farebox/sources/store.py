"""Tables that a load replaces together: written beside the old ones, then committed at once.

A table is a list of parts, folders of Parquet files under ``ROOT/TABLE/version=…``, none of
which is ever written again. Which parts make up which table is written in one small file for
each commit, ``ROOT/_commits/NUMBER.json``, and the highest number counts. A load writes its
parts first; a reader sees none of them before the commit file appears, and all of them then.
A load that breaks off leaves every table as it was, and folders that no commit names.

Each part has a label, and a load's part takes the place of the part with its label. So a
table written whole has one label, one that loads append to has a label for each load, and
one kept by day a label for each day: what a load does not touch stays where it is.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farebox.schemas import conform
from farebox.sources.raw import file_system
from farebox.sources.tables import COMPRESSION

COMMITS = "_commits"
WHOLE = "whole"


@dataclass(frozen=True)
class State:
    """What one commit says: the parts of each table by label, and the last surrogate keys."""

    number: int = 0
    load: str = ""
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    last_keys: dict[str, int] = field(default_factory=dict)

    def parts(self, table: str) -> dict[str, str]:
        return self.tables.get(table, {})


class Store:
    """Reads committed tables and begins loads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def numbers(self) -> list[int]:
        """The numbers of all commits in ascending order."""
        system, folder = file_system(self.spark, f"{self.root}/{COMMITS}")
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def commit_of(self, number: int) -> State:
        path = f"{self.root}/{COMMITS}/{number:08d}.json"
        (row,) = self.spark.read.option("wholetext", "true").text(path).collect()
        return State(**json.loads(row[0]))

    def state(self, before: str | None = None) -> State:
        """The newest commit; with ``before``, that of the newest load before this one."""
        for number in reversed(self.numbers()):
            state = self.commit_of(number)
            if before is None or state.load < before:
                return state
        return State()

    def has(self, table: str, state: State | None = None) -> bool:
        return bool((state or self.state()).parts(table))

    def read(
        self,
        table: str,
        schema: StructType,
        state: State | None = None,
        labels: list[str] | None = None,
    ) -> DataFrame:
        """A committed table, or those parts of it that ``labels`` name; empty without any."""
        parts = (state or self.state()).parts(table)
        chosen = list(parts.values()) if labels is None else [parts[n] for n in labels]
        return self.read_parts(schema, chosen)

    def read_parts(self, schema: StructType, parts: list[str]) -> DataFrame:
        """Some parts of a table, which are in one folder under the root."""
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{parts[0].split('/')[0]}"
        rows = self.spark.read.schema(schema).option("basePath", base)
        return rows.parquet(*[f"{self.root}/{part}" for part in parts]).select(*schema.names)

    def begin(self, load: str) -> Load:
        return Load(self, load)

    def register(self, database: str, table: str, state: State | None = None) -> None:
        """Put a table that was written whole into the catalog, in place of what had its name.

        As a view: replacing it is one change of the catalog, and it cannot point to
        partitions of an earlier commit as a table with a new location would.
        """
        parts = (state or self.state()).parts(table)
        if set(parts) != {WHOLE}:
            raise ValueError(f"{table} is not a committed table written whole")
        path = f"{self.root}/{parts[WHOLE]}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM parquet.`{path}`"
        )

    def unreferenced(self, keep: int = 1) -> list[str]:
        """Version folders that none of the newest ``keep`` commits names, of all tables.

        What broken loads left, and what later ones replaced. No load may be running.
        """
        named = set()
        for number in self.numbers()[-keep:]:
            for parts in self.commit_of(number).tables.values():
                named |= {"/".join(part.split("/")[:2]) for part in parts.values()}
        system, folder = file_system(self.spark, self.root)
        found = []
        for table in system.listStatus(folder):
            name = table.getPath().getName()
            if not table.isDirectory() or name.startswith("_"):
                continue
            for version in system.listStatus(table.getPath()):
                path = f"{name}/{version.getPath().getName()}"
                if "/version=" in path and path not in named:
                    found.append(f"{self.root}/{path}")
        return sorted(found)


class Load:
    """The parts that one load has written, until they are committed.

    ``before`` is the state that the load starts from: the newest of an earlier load, so that
    a load run again starts where it started the first time. ``last`` is the newest state,
    which the commit changes. A load older than that is refused.
    """

    def __init__(self, store: Store, name: str):
        self.store = store
        self.name = name
        self.last = store.state()
        self.before = store.state(before=name)
        if self.last.load > name:
            raise ValueError(f"load {self.last.load} is committed already, which is later")
        # Another run of the same load writes other folders.
        self.version = f"version={name}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, dict[str, str]] = {}
        self.last_keys: dict[str, int] = {}

    def path(self, table: str) -> str:
        return f"{self.store.root}/{table}/{self.version}"

    def write(
        self, table: str, df: DataFrame, schema: StructType, by: list[str] | None = None
    ) -> tuple[int, dict[str, str]]:
        """Write rows as folders of the columns ``by``: their number, and the parts by folder."""
        seen = Observation()
        rows = conform(df, schema).observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = rows.write.mode("errorifexists")
        writer = writer.partitionBy(*by) if by else writer
        writer.parquet(self.path(table), compression=COMPRESSION)
        return seen.get["rows"], self.written(table, bool(by))

    def written(self, table: str, folders: bool = False) -> dict[str, str]:
        """What is in the load's version of a table: the whole, or its folders."""
        if not folders:
            return {WHOLE: f"{table}/{self.version}"}
        system, folder = file_system(self.store.spark, self.path(table))
        names = [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()]
        return {name: f"{table}/{self.version}/{name}" for name in names if "=" in name}

    def replace(self, table: str, df: DataFrame, schema: StructType) -> int:
        """Write a table whole."""
        rows, self.tables[table] = self.write(table, df, schema)
        return rows

    def adopt(self, table: str) -> None:
        """Take for the whole table what was written to its ``path`` by other means."""
        self.tables[table] = self.written(table)

    def append(self, table: str, df: DataFrame, schema: StructType) -> int:
        """Write the rows that this load adds; run again, it replaces them."""
        rows, parts = self.write(table, df, schema)
        earlier = self.last.parts(table)
        self.tables[table] = {**earlier, self.name: parts[WHOLE]}
        return rows

    def append_checked(
        self, table: str, rejected: str, df: DataFrame, schema: StructType
    ) -> dict[str, int]:
        """As ``append``, of rows with a flag ``accepted``: the others go to a second table.

        Both are written in one pass over ``df``. Returns the number of rows of each.
        """
        taken = F.col("accepted")
        seen = Observation()
        rows = conform(df, schema).observe(
            seen, F.count_if(taken).alias(table), F.count_if(~taken).alias(rejected)
        )
        rows.write.mode("errorifexists").partitionBy("accepted").parquet(self.path(table))
        parts = self.written(table, folders=True)
        for name, flag in ((table, "true"), (rejected, "false")):
            kept = {n: p for n, p in self.last.parts(name).items() if n != self.name}
            if f"accepted={flag}" in parts:
                kept[self.name] = parts[f"accepted={flag}"]
            self.tables[name] = kept
        return seen.get

    def replace_folders(
        self, table: str, df: DataFrame, schema: StructType, by: str, touched: list[str]
    ) -> int:
        """Write the ``touched`` folders of a table kept by a column anew; all others stay.

        A touched folder without rows goes.
        """
        rows, parts = self.write(table, df, schema, [by])
        if set(parts) - set(touched):
            raise ValueError(f"{table}: rows outside the folders touched")
        kept = {n: p for n, p in self.last.parts(table).items() if n not in touched}
        self.tables[table] = {**kept, **parts}
        return rows

    def read(self, table: str, schema: StructType) -> DataFrame:
        """A table as it will be once this load is committed."""
        parts = self.tables.get(table, self.last.parts(table))
        return self.store.read_parts(schema, list(parts.values()))

    def has(self, table: str) -> bool:
        return bool(self.tables.get(table, self.last.parts(table)))

    def commit(self) -> State:
        """Make all that was written what readers see, in one step.

        A commit made since this load began, by another load, is an error.
        """
        store, number = self.store, self.last.number + 1
        state = State(
            number,
            self.name,
            {**self.last.tables, **self.tables},
            {**self.last.last_keys, **self.last_keys},
        )
        system, final = file_system(store.spark, f"{store.root}/{COMMITS}/{number:08d}.json")
        _, draft = file_system(store.spark, f"{store.root}/{COMMITS}/.{uuid.uuid4().hex}.draft")
        out = system.create(draft, False)
        try:
            out.write(bytearray(json.dumps(state.__dict__).encode()))
        finally:
            out.close()
        # A rename puts the whole file there or nothing.
        if system.exists(final) or not system.rename(draft, final):
            raise RuntimeError(f"commit {number} was made by another load")
        return state
