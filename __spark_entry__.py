
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.testing import fixtures
from farebox.operators import quality, scd2, staging
from farebox.operators.dimensions import build_dim_user
from farebox.operators.keys import assign_surrogate_key
from farebox.plans.increment import run_increment
from farebox.plans.nightly import Warehouse, run_pipeline
from farebox.plans.star import SCHEMAS, Star
from farebox.schemas import CHECKED, RAW, REJECTED, STAGING
from farebox.session import shared_folder
from farebox.sources.raw import footer_scan, read_or_empty, read_raw
from farebox.sources.store import Store
from farebox.sources.tables import write_mart, write_table
from farebox.testing.oracle import ORACLE_SQL

# The operators for training text are a package of their own; without it, the queries of
# the warehouse remain.
try:
    import corpus_pipeline
    from farebox.llm import queries as llm
except ImportError:
    llm = None

_stars: dict[tuple[str, str], Star] = {}
_first_nights: dict[tuple[str, str], str] = {}


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/farebox-{uuid.uuid4()}"


def _star(spark: SparkSession, sf_dir: str) -> Star:
    """The star schema over the raw zone derived from ``sf_dir``.

    A query reads the tables it builds on from storage, as the steps of a nightly
    load do. They are written once per application, into the shared folder.
    """
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _stars:
        folder = _folder(spark)
        entities: dict[str, DataFrame] = {}

        def raw(entity: str) -> DataFrame:
            if entity not in entities:
                rows = fixtures.ENTITIES[entity](spark, sf_dir)
                write_table(rows, f"{folder}/raw/{entity}", RAW[entity])
                entities[entity] = read_raw(spark, f"{folder}/raw", entity)
            return entities[entity]

        def keep(table: str, df: DataFrame) -> DataFrame:
            write_table(df, f"{folder}/{table}", SCHEMAS[table])
            return read_raw(spark, folder, table)

        _stars[name] = Star(raw, keep, as_of=fixtures.FIRST_LOAD)
    return _stars[name]


def _staged(entity: str):
    return lambda spark, sf_dir: staging.load_staging(
        fixtures.ENTITIES[entity](spark, sf_dir), entity, fixtures.LOAD_TS
    )


def _built(table: str):
    return lambda spark, sf_dir: _star(spark, sf_dir).build(table)


def _silver(entity: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        delivered = fixtures.REDELIVERED[entity](_star(spark, sf_dir).raw(entity))
        return staging.clean(delivered, entity)

    return query


def _surrogate_keys_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys for users whose ids are said to be unique."""
    named = _star(spark, sf_dir).raw("users").select("user_id", "created_at", "email")
    return assign_surrogate_key(named, "user_id", "user_sk", unique=True)


def _staging_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging table after two loads."""
    path = _folder(spark)
    users = fixtures.users(spark, sf_dir)
    for moment in (fixtures.LOAD_TS, fixtures.CHECK_TS):
        staged = staging.load_staging(users, "users", moment)
        write_table(staged, path, STAGING["users"], mode="append")
    return spark.read.parquet(path)


def _routes_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routes of one folder that is there and one that is not."""
    folder = _folder(spark)
    write_table(fixtures.routes(spark, sf_dir), f"{folder}/routes", RAW["routes"])
    there, absent = (
        read_or_empty(spark, f"{folder}/{name}", RAW["routes"]) for name in ("routes", "none")
    )
    return there.unionByName(absent)


def _nightly(table: str):
    """A table of the nightly load over a raw zone whose feeds repeat themselves."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _folder(spark)
        for entity, redelivered in fixtures.REDELIVERED.items():
            rows = redelivered(fixtures.raw(spark, sf_dir, entity))
            write_table(rows, f"{folder}/raw/{entity}", RAW[entity])
        run_pipeline(
            spark, f"{folder}/raw", folder, load_ts=fixtures.LOAD_TS, tables=[table], stage=False
        )
        return Store(spark, folder).read(table, SCHEMAS[table])

    return query


def _delivered(rows: dict[str, DataFrame], folder: str) -> str:
    """A raw zone with some entities."""
    for entity, df in rows.items():
        write_table(df, f"{folder}/{entity}", RAW[entity])
    return folder


def _kept_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users after two loads, the second with new ids between those known."""
    folder = _folder(spark)
    users = fixtures.raw(spark, sf_dir, "users")
    nights = {fixtures.LOAD_TS: users.filter("user_id % 3 <> 0"), fixtures.NEXT_LOAD_TS: users}
    for night, (load_ts, rows) in enumerate(nights.items()):
        raw = _delivered({"users": rows}, f"{folder}/raw{night}")
        run_pipeline(spark, raw, folder, load_ts=load_ts, tables=["dim_user"], stage=False)
    return Store(spark, folder).read("dim_user", SCHEMAS["dim_user"])


def _after_broken_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users after a load, one that broke off behind the users, and one of vehicles."""
    folder = _folder(spark)
    users = fixtures.raw(spark, sf_dir, "users")
    vehicles = fixtures.raw(spark, sf_dir, "vehicles")
    raw = _delivered({"users": users, "vehicles": vehicles}, f"{folder}/raw")
    run_pipeline(spark, raw, folder, load_ts=fixtures.LOAD_TS, tables=["dim_user"], stage=False)
    broken = Warehouse(spark, folder, fixtures.CHECK_TS, fixtures.FIRST_LOAD)
    moved = broken.keep_silver("users", staging.clean(fixtures.redelivered_users(users), "users"))
    broken.keep("dim_user", build_dim_user(moved, True, *broken.known_keys("dim_user")))
    load_ts = fixtures.NEXT_LOAD_TS
    run_pipeline(spark, raw, folder, load_ts=load_ts, tables=["dim_vehicle"], stage=False)
    return Store(spark, folder).read("dim_user", SCHEMAS["dim_user"])


def _staging_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged users after a load that was run twice."""
    folder = _folder(spark)
    raw = _delivered({"users": fixtures.users(spark, sf_dir)}, f"{folder}/raw")
    others = [entity for entity in RAW if entity != "users"]
    for _ in range(2):
        run_pipeline(
            spark, raw, folder, load_ts=fixtures.LOAD_TS, tables=["dim_user"], may_be_missing=others
        )
    return Store(spark, folder).read("stg_users", STAGING["users"])


def _first_night(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse after the first of two nights, loaded once per application."""
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _first_nights:
        folder = _folder(spark)
        # Rides are joined from three tables, once for all the deliveries they are split into.
        stored = {"rides": _star(spark, sf_dir).raw("rides")}
        for night, rows in enumerate(fixtures.split_deliveries(spark, sf_dir, stored)):
            _delivered(rows, f"{folder}/raw{night}")
        run_increment(
            spark, f"{folder}/raw0", folder, as_of=fixtures.FIRST_LOAD, load_ts=fixtures.LOAD_TS
        )
        _first_nights[name] = folder
    return _first_nights[name]


def _increment(table: str):
    """A fact after a night's delivery was merged into that of the night before."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _first_night(spark, sf_dir)
        # Run again, a load starts from where it started the first time.
        load_ts = fixtures.NEXT_LOAD_TS
        run_increment(
            spark, f"{folder}/raw1", folder, as_of=fixtures.FIRST_LOAD, load_ts=load_ts
        )
        return Store(spark, folder).read(table, SCHEMAS[table])

    return query


def _quarantine(spark: SparkSession, sf_dir: str) -> Store:
    """A store after staging payments of which some have values that do not fit."""
    folder = _folder(spark)
    faulty = fixtures.faulty_payments(_star(spark, sf_dir).raw("payments"))
    store = Store(spark, folder)
    load = store.begin("1")
    checked = staging.check_types(faulty, "payments", fixtures.LOAD_TS)
    load.append_checked("stg_payments", "rejected_payments", checked, CHECKED["payments"])
    load.commit()
    return store


def _quarantine_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir).read("stg_payments", STAGING["payments"])


def _quarantine_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _quarantine(spark, sf_dir).read("rejected_payments", REJECTED)
    return rejected.withColumn("reasons", F.array_join("reasons", "; "))


def _route_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions of routes after the snapshots of three days, merged at once."""
    routes = _star(spark, sf_dir).raw("routes")
    snapshots = {
        fixtures.FIRST_LOAD: routes,
        fixtures.SECOND_LOAD: fixtures.changed_routes(routes),
        fixtures.THIRD_LOAD: routes,
    }
    none = spark.createDataFrame([], SCHEMAS["dim_route"])
    return scd2.merge_route_snapshots(none, snapshots, after=0)


def _surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys for users with repeated and null ids, after 1000 keys already given."""
    users = fixtures.redelivered_users(_star(spark, sf_dir).raw("users"))
    named = users.select("user_id", "created_at", "email")
    return assign_surrogate_key(named, "user_id", "user_sk", after=1000)


def _dim_route_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return scd2.merge_routes(
        star.table("dim_route"), fixtures.changed_routes(star.raw("routes")), fixtures.SECOND_LOAD
    )


def _current_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.current_rows(_dim_route_scd2(spark, sf_dir))


def _stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly mart, written by month and read back with its month column."""
    path = _folder(spark)
    write_mart(_star(spark, sf_dir).build("user_behavior_hourly"), path)
    return spark.read.parquet(path)


def _footers(spark: SparkSession, stored: DataFrame) -> DataFrame:
    """A stored table as a scan of its footers."""
    return footer_scan(spark, *stored.inputFiles())


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    counted = ["dim_user", "dim_route", "dim_vehicle", "fact_rides"]
    return quality.row_counts({name: _footers(spark, star.table(name)) for name in counted})


def _null_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return quality.null_checks(
        {
            "fact_rides": (star.table("fact_rides"), ["user_sk", "route_sk"]),
            "dim_user": (star.table("dim_user"), ["user_id"]),
        }
    )


def _freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = _star(spark, sf_dir).table("fact_rides")
    newest = (_footers(spark, rides), rides, "date_sk", "start_time")
    return quality.freshness_of_days({"fact_rides": newest}, fixtures.CHECK_TS)


def _duplicate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates in the tables, and in deliveries that do hold some."""
    star = _star(spark, sf_dir)
    return quality.duplicate_checks(
        {
            "dim_user": (star.table("dim_user"), "user_id"),
            "fact_rides": (star.table("fact_rides"), "ride_id"),
            "redelivered_users": (fixtures.redelivered_users(star.raw("users")), "user_id"),
            "redelivered_rides": (fixtures.redelivered_rides(star.raw("rides")), "ride_id"),
        },
        dense=["dim_user", "redelivered_users"],
    )


def _quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_log(
        _null_checks(spark, sf_dir),
        _freshness(spark, sf_dir),
        _duplicate_checks(spark, sf_dir),
        fixtures.MAX_LAG_SECONDS,
        fixtures.CHECK_TS,
    )


def _failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failed_checks(_quality_log(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """The daily dashboard from raw tables."""
    return queries()["dashboard_daily"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **{f"stg_{entity}": _staged(entity) for entity in RAW},
        **{f"silver_{entity}": _silver(entity) for entity in RAW},
        "staging_appended": _staging_appended,
        "routes_or_empty": _routes_or_empty,
        "surrogate_keys_unique": _surrogate_keys_unique,
        "surrogate_keys": _surrogate_keys,
        "surrogate_keys_kept": _kept_keys,
        "dim_user_after_broken_load": _after_broken_load,
        "staging_repeated": _staging_repeated,
        "quarantine_accepted": _quarantine_accepted,
        "quarantine_rejected": _quarantine_rejected,
        "dim_user": _built("dim_user"),
        "dim_vehicle": _built("dim_vehicle"),
        "dim_date": _built("dim_date"),
        "dim_route_first_load": _built("dim_route"),
        "dim_route_scd2": _dim_route_scd2,
        "dim_route_three_snapshots": _route_snapshots,
        "current_routes": _current_routes,
        "fact_rides": _built("fact_rides"),
        "fact_payments": _built("fact_payments"),
        "fact_vehicle_movement": _built("fact_vehicle_movement"),
        "user_behavior_rides": _built("user_behavior_rides"),
        "user_behavior_payments": _built("user_behavior_payments"),
        "user_behavior_hourly": _built("user_behavior_hourly"),
        "user_behavior_stored": _stored_mart,
        "dashboard_daily": _built("dashboard_daily"),
        "row_counts": _row_counts,
        "null_checks": _null_checks,
        "freshness": _freshness,
        "duplicate_checks": _duplicate_checks,
        "quality_log": _quality_log,
        "failed_checks": _failed_checks,
        "increment_rides": _increment("fact_rides"),
        "increment_payments": _increment("fact_payments"),
        "increment_movement": _increment("fact_vehicle_movement"),
        "nightly_dashboard": _nightly("dashboard_daily"),
        "nightly_payments": _nightly("fact_payments"),
        **(llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    return ORACLE_SQL | (llm.ORACLE_SQL if llm else {})
