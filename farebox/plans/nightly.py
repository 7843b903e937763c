"""The nightly load: raw zone to marts and quality log, as one application."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from farebox.functions.dates import date_sk, moment_or_now
from farebox.operators import quality
from farebox.operators.scd2 import current_rows, merge_route_snapshots
from farebox.operators.staging import (
    BUSINESS_KEYS,
    DAY_OF,
    check_types,
    clean,
    cleaning_findings,
    load_staging,
)
from farebox.plans.star import SCHEMAS, Star
from farebox.schemas import CHECKED, INT, KEYS, QUALITY_LOG, RAW, STAGING, conform
from farebox.session import apply_settings
from farebox.sources.raw import read_or_empty, read_raw
from farebox.sources.store import WHOLE, Load, Store
from farebox.sources.tables import day_layout, write_mart

# Tables in the order of the load.
TABLES = (
    "dim_user",
    "dim_route",
    "dim_vehicle",
    "dim_date",
    "fact_rides",
    "fact_payments",
    "fact_vehicle_movement",
    "dashboard_daily",
    "user_behavior_hourly",
)
# The tables whose rows are counted.
COUNTED = ("dim_user", "dim_route", "dim_vehicle", "fact_rides")
# Facts that are kept by day, and the entity that each has a row of.
BY_DAY = {"fact_rides": "rides", "fact_payments": "payments"}
# Our own choice: the newest ride may be a day old.
MAX_LAG_SECONDS = 86_400
OPEN = "is_current=true"

# Cleaned entities as they are stored: those with a day have it, and are kept by it.
SILVER = {
    entity: RAW[entity] if entity not in DAY_OF else StructType([*RAW[entity], StructField("date_sk", INT)])
    for entity in RAW
}


class Warehouse:
    """One load's view of the warehouse: its steps write parts, ``finish`` commits them."""

    def __init__(self, spark: SparkSession, root: str, load_ts: dt.datetime, as_of: dt.date):
        self.spark = spark
        self.store = Store(spark, root)
        self.load: Load = self.store.begin(load_ts.strftime("%Y%m%dT%H%M%S%f"))
        self.load_ts = load_ts
        self.as_of = as_of
        self.rows: dict[str, int] = {}
        self.written: list[str] = []

    def read(self, table: str) -> DataFrame:
        return self.load.read(table, SCHEMAS[table])

    # ---- dimensions

    def known_keys(self, name: str) -> tuple[DataFrame, int]:
        """The keys given by loads before this one, and the last of them."""
        before = self.load.before
        parts = list(before.parts(f"keys_{name}").values())
        known = self.store.read_parts(KEYS[name], parts)
        return known, before.last_keys.get(name, 0)

    def keep_keys(self, name: str) -> None:
        """Add what this load has given to the stored keys."""
        _, after = self.known_keys(name)
        key, sk = KEYS[name].names
        new = self.read(name).filter(F.col(sk) > after).select(key, sk)
        rows, parts = self.load.write(f"keys_{name}", new, KEYS[name])
        earlier = self.load.before.parts(f"keys_{name}")
        self.load.tables[f"keys_{name}"] = {**earlier, self.load.name: parts[WHOLE]}
        self.load.last_keys[name] = after + rows

    def route_versions(self, snapshots: DataFrame | dict[dt.date, DataFrame]) -> DataFrame:
        """Open versions after the snapshots, and those that they close; reads open ones only."""
        before = self.load.before
        labels = [OPEN] if OPEN in before.parts("dim_route") else []
        current = self.store.read("dim_route", SCHEMAS["dim_route"], before, labels)
        if not isinstance(snapshots, dict):
            snapshots = {self.as_of: snapshots}
        return merge_route_snapshots(current, snapshots, before.last_keys.get("dim_route", 0))

    def keep_routes(self, versions: DataFrame) -> int:
        """Replace the open versions and add the closed ones to those closed before."""
        before, schema = self.load.before, SCHEMAS["dim_route"]
        rows, parts = self.load.write("dim_route", versions, schema, ["is_current"])
        closed = {n: p for n, p in before.parts("dim_route").items() if n != OPEN}
        if "is_current=false" in parts:
            closed[f"closed by {self.load.name}"] = parts.pop("is_current=false")
        self.load.tables["dim_route"] = {**closed, **parts}
        # The newest key is that of an open version.
        newest = self.store.read_parts(schema, list(parts.values()))
        last = newest.agg(F.max("route_sk")).first()[0]
        self.load.last_keys["dim_route"] = last or before.last_keys.get("dim_route", 0)
        return rows

    # ---- all tables

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table and read it back."""
        if name == "dim_route":
            self.rows[name] = self.keep_routes(df)
        elif name == "user_behavior_hourly":
            self.rows[name] = write_mart(df, self.load.path(name))
            self.load.adopt(name)
        elif name in BY_DAY:
            laid = day_layout(df, "date_sk")
            self.rows[name], parts = self.load.write(name, laid, SCHEMAS[name], ["date_sk"])
            self.load.tables[name] = parts
            expected = self.rows.get(f"silver_{BY_DAY[name]}")
            if expected not in (None, self.rows[name]):
                raise RuntimeError(f"{name} has {self.rows[name]} rows for {expected}")
        else:
            self.rows[name] = self.load.replace(name, df, SCHEMAS[name])
        if name in KEYS:
            self.keep_keys(name)
        self.written.append(name)
        return self.read(name)

    def keep_silver(self, entity: str, df: DataFrame) -> DataFrame:
        table, schema = f"silver_{entity}", SILVER[entity]
        if entity in DAY_OF:
            day = date_sk(F.col(DAY_OF[entity]))
            laid = day_layout(df.withColumn("date_sk", day), "date_sk")
            self.rows[table], parts = self.load.write(table, laid, schema, ["date_sk"])
            self.load.tables[table] = parts
        else:
            self.rows[table] = self.load.replace(table, df, schema)
        return self.load.read(table, schema)

    def newest_rides(self) -> DataFrame:
        """The rides of the last day there is, found by the names of the parts."""
        parts = self.load.tables.get("fact_rides", self.load.last.parts("fact_rides"))
        days = [label for label in parts if not label.endswith("__HIVE_DEFAULT_PARTITION__")]
        chosen = [parts[max(days)]] if days else []
        return self.store.read_parts(SCHEMAS["fact_rides"], chosen)

    def counts(self) -> DataFrame:
        """The rows of the counted tables that were loaded or are stored."""
        found = []
        for name in COUNTED:
            if self.load.has(name):
                # Of dim_route a load writes the open versions and those it closes.
                known = None if name == "dim_route" else self.rows.get(name)
                found.append((name, self.read(name).count() if known is None else known))
        return self.spark.createDataFrame(found, "table_name string, row_count long")

    def finish(
        self,
        log: DataFrame | None,
        publish: Callable[[str, DataFrame], None] | None,
        database: str | None,
    ) -> DataFrame:
        """Store the log, commit, and hand the tables on; returns the load's log rows."""
        if log is not None:
            self.load.append("data_quality_log", log, QUALITY_LOG)
        state = self.load.commit()
        for name in self.written:
            if publish is not None:
                publish(name, self.store.read(name, SCHEMAS[name], state))
            if database is not None and set(state.parts(name)) == {WHOLE}:
                self.store.register(database, name, state)
        labels = [self.load.name] if log is not None else []
        return self.store.read("data_quality_log", QUALITY_LOG, state, labels)


def run_pipeline(
    spark: SparkSession,
    raw_root: str,
    warehouse: str,
    as_of: dt.date | None = None,
    load_ts: dt.datetime | None = None,
    tables: Iterable[str] = TABLES,
    stage: bool = True,
    publish: Callable[[str, DataFrame], None] | None = None,
    max_lag_seconds: int = MAX_LAG_SECONDS,
    may_be_missing: Iterable[str] = (),
    database: str | None = None,
    quarantine: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Load ``tables`` and check them; returns row counts and the new log rows.

    Each step writes its tables under ``warehouse`` and the next one scans what was written;
    readers see all of it at once, by the commit at the end, or nothing (``sources.store``).
    Tables not asked for are taken as they are stored, and built where there are none. Counts
    and checks cover what was loaded or is stored. ``stage`` adds the raw entities to the
    staging tables. ``publish`` receives every table written once it is committed, to copy it
    to a database, and tables written whole are put into the catalog's ``database``. A raw
    entity that is not there is an error, unless it is among those that ``may_be_missing``,
    which then are empty.

    A value that does not fit its declared type fails the load. Under ``quarantine``, which
    needs staging, its row goes to a table ``rejected_…`` with the reasons instead, the log
    has how many there were, and the load goes on with the others.

    A load is named by ``load_ts``. Run again, it starts from the route history and the keys
    that it found the first time, and replaces what it added to staging and the log. A load
    that broke off is simply run again.
    """
    apply_settings(spark)
    load_ts = load_ts or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    wanted = set(tables)
    unknown = wanted - set(TABLES)
    if unknown:
        raise ValueError(f"unknown tables: {', '.join(sorted(unknown))}")
    house = Warehouse(spark, warehouse, load_ts, as_of or load_ts.date())

    def raw(entity: str) -> DataFrame:
        if entity in may_be_missing:
            return read_or_empty(spark, f"{raw_root}/{entity}", RAW[entity])
        return read_raw(spark, raw_root, entity)

    if quarantine and not stage:
        raise ValueError("rows are put into quarantine while they are staged")
    silver: dict[str, DataFrame] = {}
    findings: list[tuple[str, str, int]] = []
    accepted: dict[str, DataFrame] = {}
    for entity in RAW if stage else ():
        table, rejected = f"stg_{entity}", f"rejected_{entity}"
        if quarantine:
            checked = check_types(raw(entity), entity, load_ts)
            rows = house.load.append_checked(table, rejected, checked, CHECKED[entity])
            findings.append((f"raw_{entity}", "values do not fit", rows[rejected]))
            part = house.load.tables[table].get(house.load.name)
            accepted[entity] = house.store.read_parts(STAGING[entity], [part] if part else [])
        else:
            house.load.append(table, load_staging(raw(entity), entity, load_ts), STAGING[entity])

    def cleaned(entity: str) -> DataFrame:
        if entity not in silver:
            delivered = accepted[entity] if quarantine else raw(entity)
            silver[entity] = house.keep_silver(entity, clean(delivered, entity))
            found = cleaning_findings(delivered, entity)
            dropped, kept = found["nulls"], house.rows[f"silver_{entity}"]
            findings.append((f"raw_{entity}", f"{BUSINESS_KEYS[entity][0]} is null", dropped))
            findings.append((f"raw_{entity}", "duplicates", found["rows"] - dropped - kept))
        return silver[entity]

    star = Star(
        cleaned,
        house.keep,
        as_of=house.as_of,
        cleaned=True,
        route_versions=house.route_versions,
        known_keys=house.known_keys,
    )
    for name in TABLES:
        if name not in wanted and house.load.has(name):
            star.kept[name] = house.read(name)
    for name in TABLES:
        if name in wanted:
            star.table(name)

    counts = house.counts()
    log = check_quality(house, max_lag_seconds).unionByName(
        _cleaning_log(spark, findings, load_ts)
    )
    return counts, house.finish(log, publish, database)


def _cleaning_log(
    spark: SparkSession, findings: list[tuple[str, str, int]], check_date: dt.datetime
) -> DataFrame:
    """What cleaning left out: rows without a key, and further deliveries of one."""
    rows = [(t, kind, str(n), "FAIL" if n else "PASS") for t, kind, n in findings]
    frame = spark.createDataFrame(
        rows, "table_name string, check_type string, result_value string, status string"
    )
    return conform(frame.withColumn("check_date", moment_or_now(check_date)), QUALITY_LOG)


def check_quality(house: Warehouse, max_lag_seconds: int) -> DataFrame:
    """The log rows of one check of those tables that were loaded or are stored."""

    def there(**checks):
        return {name: check() for name, check in checks.items() if house.load.has(name)}

    nulls = there(
        fact_rides=lambda: (house.read("fact_rides"), ["user_sk", "route_sk"]),
        dim_user=lambda: (house.read("dim_user"), ["user_id"]),
    )
    lags = there(fact_rides=lambda: (house.newest_rides(), "start_time"))
    duplicates = there(
        dim_user=lambda: (house.read("dim_user"), "user_id"),
        dim_route=lambda: (current_rows(house.read("dim_route")), "route_id"),
        fact_rides=lambda: (house.read("fact_rides"), "ride_id"),
        fact_payments=lambda: (house.read("fact_payments"), "payment_id"),
    )
    return quality.quality_log(
        quality.null_checks(nulls) if nulls else None,
        quality.freshness(lags, house.load_ts) if lags else None,
        quality.duplicate_checks(duplicates) if duplicates else None,
        max_lag_seconds,
        house.load_ts,
        house.spark,
    )
