"""A load of what is new: deliveries of single days merged into the stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farebox.functions.dates import date_sk
from farebox.operators import facts
from farebox.operators.dimensions import build_dim_user, build_dim_vehicle
from farebox.operators.keys import SENT_ROWS, Sent, sent_keys
from farebox.operators.staging import BUSINESS_KEYS, DAY_OF, bronze_to_silver, clean
from farebox.plans.nightly import SILVER, Warehouse
from farebox.plans.star import SCHEMAS
from farebox.schemas import KEYS, MOVEMENT_SUMS, RAW
from farebox.session import apply_settings
from farebox.sources.raw import path_exists, read_raw
from farebox.sources.tables import day_layout

# The fact of each entity kept by day.
FACT_OF = {"rides": "fact_rides", "payments": "fact_payments"}
# Rows of a day that one group of a merge holds, and one file.
GROUP_ROWS = 1_000_000
# Dimensions of up to this many keys are sent to all tasks, in runs if they have many.
SENT_KEYS = 1 << 23
# Up to this many moved keys are sent to all tasks.
SENT_MOVED = 1 << 18


def run_increment(
    spark: SparkSession,
    delivery: str,
    warehouse: str,
    as_of: dt.date | None = None,
    load_ts: dt.datetime | None = None,
    publish: Callable[[str, DataFrame], None] | None = None,
) -> dict[str, list[int | None]]:
    """Merge a delivery into the warehouse; returns the days of each fact that were rebuilt.

    ``delivery`` has a folder for each entity delivered: new and corrected users, vehicles,
    rides, payments and positions, and whole snapshots of routes. Late rows and corrections of
    any day may be among them, the latest delivery of a key counts, and a correction may move
    a row to another day. The stored tables are then those that a whole load of all deliveries
    would give, with the keys given so far.

    Only the days that change are read whole and written: the days of what was delivered,
    those where its keys were before, and those with rows of users or vehicles that are new or
    of routes with a new version. To find the latter two, the key columns of all days are
    read. Days are handled by number on the driver, one for each day there is. Marts are left
    to the next whole load.

    A delivery is brought together by key once, to be cleaned, and the first of an entity is
    stored as it then is. A later one meets the stored rows by day and key, in one shuffle that
    also lays them out by day; only keys that move to another day are brought together by key
    alone. Facts take the days of the rows they are built from, so they are written as these lie.
    """
    apply_settings(spark)
    load_ts = load_ts or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    house = Warehouse(spark, warehouse, load_ts, as_of or load_ts.date())
    delivered = {
        entity: _kept_delivery(house, entity, clean(read_raw(spark, delivery, entity), entity))
        for entity in RAW
        if path_exists(spark, f"{delivery}/{entity}")
    }
    changed = _merged_dimensions(house, delivered)
    rebuilt = {}
    for entity, fact in FACT_OF.items():
        days = _merged_days(house, entity, delivered.get(entity))
        days |= _days_with(house, entity, changed)
        if days or not house.load.has(fact):
            _rebuild(house, entity, fact, days)
        rebuilt[fact] = sorted(days, key=lambda day: (day is None, day))
    days = _merged_days(house, "vehicle_positions", delivered.get("vehicle_positions"))
    rebuilt["fact_vehicle_movement"] = sorted(days, key=lambda day: (day is None, day))
    _rebuild_movement(house, days)
    house.finish(None, publish, None)
    return rebuilt


def label(day: int | None) -> str:
    """The folder of a day."""
    return f"date_sk={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def day_of(label: str) -> int | None:
    """The day of a folder."""
    day = label.removeprefix("date_sk=")
    return None if day == "__HIVE_DEFAULT_PARTITION__" else int(day)


def _parts(house: Warehouse, entity: str) -> dict[str, str]:
    table, load = f"silver_{entity}", house.load
    return load.tables.get(table, load.last.parts(table))


def _silver(house: Warehouse, entity: str, days: Iterable[int | None] | None = None) -> DataFrame:
    """The stored rows of an entity, of all days or of some, which alone are scanned."""
    parts = _parts(house, entity)
    chosen = parts if days is None else {label(day) for day in days} & set(parts)
    return house.store.read_parts(SILVER[entity], [parts[name] for name in chosen])


def _kept_delivery(house: Warehouse, entity: str, rows: DataFrame) -> DataFrame:
    """A cleaned delivery, stored for the steps that read it; no commit names it.

    The first delivery of an entity kept by day has nothing to be merged with: it is stored as
    the entity's rows at once.
    """
    table = f"delivered_{entity}"
    if entity in DAY_OF and not _parts(house, entity):
        return house.keep_silver(entity, rows)
    if entity in DAY_OF:
        rows = rows.withColumn("date_sk", date_sk(F.col(DAY_OF[entity])))
    _, parts = house.load.write(table, rows, SILVER[entity])
    return house.store.read_parts(SILVER[entity], list(parts.values()))


def _merged_dimensions(
    house: Warehouse, delivered: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Bring the dimensions up to the delivery; the business keys whose surrogate key is new."""
    changed = {}
    builders = {"users": ("dim_user", build_dim_user), "vehicles": ("dim_vehicle", build_dim_vehicle)}
    for entity, (name, build) in builders.items():
        if entity in delivered or not house.load.has(name):
            stored = _silver(house, entity)
            rows = stored.unionByName(delivered[entity]) if entity in delivered else stored
            silver = house.keep_silver(entity, bronze_to_silver(rows, *BUSINESS_KEYS[entity]))
            known, after = house.known_keys(name)
            house.keep(name, build(silver, True, known, after))
            key, sk = KEYS[name].names
            changed[key] = house.read(name).filter(F.col(sk) > after).select(key)
    if "routes" in delivered or not house.load.has("dim_route"):
        after = house.load.before.last_keys.get("dim_route", 0)
        routes = house.keep_silver("routes", delivered.get("routes", _silver(house, "routes")))
        versions = house.keep("dim_route", house.route_versions(routes))
        changed["route_id"] = versions.filter(
            F.col("is_current") & (F.col("route_sk") > after)
        ).select("route_id")
    return changed


def _distinct_days(rows: DataFrame) -> set[int | None]:
    return {row[0] for row in rows.select("date_sk").distinct().collect()}


def _merged_days(house: Warehouse, entity: str, delivered: DataFrame | None) -> set[int | None]:
    """Merge a delivery into the silver rows of the days it touches; these days."""
    if delivered is None:
        return set()
    table = f"silver_{entity}"
    if table in house.load.tables:
        return {day_of(name) for name in house.load.tables[table]}
    key = BUSINESS_KEYS[entity][0]
    stored = _silver(house, entity).select(key, F.col("date_sk").alias("was"))
    met = stored.join(delivered.select(key, "date_sk"), key).withColumn(
        "moves", ~F.col("was").eqNullSafe(F.col("date_sk"))
    )
    before = met.groupBy("was").agg(F.count_if("moves").alias("moved")).collect()
    days = _distinct_days(delivered) | {row["was"] for row in before}
    rows = _silver(house, entity, days).unionByName(delivered)
    moved = None
    moves = sum(row["moved"] for row in before)
    if moves:
        name = f"moved_{entity}"
        schema = StructType([RAW[entity][key]])
        _, parts = house.load.write(name, met.filter("moves").select(key), schema)
        moved = house.store.read_parts(schema, list(parts.values()))
        moved = F.broadcast(moved) if moves <= SENT_MOVED else moved.hint("merge")
    house.load.replace_folders(
        table,
        _latest_of_days(rows, entity, moved),
        SILVER[entity],
        "date_sk",
        [label(day) for day in days],
    )
    return days


def _latest_of_days(rows: DataFrame, entity: str, moved: DataFrame | None) -> DataFrame:
    """The latest row of each key, ready to be written to a folder for each day.

    ``moved`` has the keys with rows of several days. All others are compared within their
    day, in groups of some GROUP_ROWS of it, so that one shuffle compares and lays them out.
    """
    key, event_time = BUSINESS_KEYS[entity]
    groups = F.ceil(F.col("count") / GROUP_ROWS).alias("groups")
    sizes = rows.groupBy("date_sk").count().select(F.col("date_sk").alias("day"), groups)
    if moved is not None:
        several = rows.join(moved, key, "left_semi").drop("date_sk")
        latest = bronze_to_silver(several, key, event_time)
        dated = latest.withColumn("date_sk", date_sk(F.col(DAY_OF[entity])))
        rows = rows.join(moved, key, "left_anti").unionByName(dated)
    grouped = (
        rows.join(F.broadcast(sizes), F.col("date_sk").eqNullSafe(F.col("day")))
        .withColumn("group", F.pmod(F.xxhash64(key), "groups"))
        .drop("day", "groups")
        .repartition("date_sk", "group")
    )
    return bronze_to_silver(grouped, key, event_time, within=("date_sk", "group")).drop("group")


def _days_with(house: Warehouse, entity: str, changed: dict[str, DataFrame]) -> set[int | None]:
    """The days that have rows of any of the changed business keys."""
    found = [
        _silver(house, entity).select(key, "date_sk").distinct()
        .join(keys.hint("merge"), key, "left_semi").select("date_sk")
        for key, keys in changed.items()
        if key in RAW[entity].names
    ]
    return _distinct_days(reduce(DataFrame.unionByName, found)) if found else set()


def _rebuild(house: Warehouse, entity: str, fact: str, days: set[int | None]) -> None:
    """The days of a fact from the silver rows of these days; of all days if there is no fact."""
    if not house.load.has(fact):
        days |= _distinct_days(_silver(house, entity))
    rows = _silver(house, entity, days)
    written = house.load.replace_folders(
        fact,
        _fact_of(house, fact, rows),
        SCHEMAS[fact],
        "date_sk",
        [label(day) for day in days],
    )
    expected = rows.count()
    if written != expected:
        raise RuntimeError(f"{fact} has {written} rows for {expected}")
    house.written.append(fact)


def _fact_of(house: Warehouse, fact: str, rows: DataFrame) -> DataFrame:
    """A fact from stored silver rows, ready to be written to a folder for each day.

    Rows stay in the files of their days while the dimensions are small enough to be sent to
    them, and are laid out anew otherwise.
    """
    names = ["dim_user", "dim_route", "dim_vehicle"] if fact == "fact_rides" else ["dim_user"]
    sent = [_sent(house, name) for name in names]
    dims = [
        house.read(name).hint("merge") if dim is None else dim
        for name, dim in zip(names, sent, strict=True)
    ]
    build = facts.build_fact_rides if fact == "fact_rides" else facts.build_fact_payments
    built = build(rows, *dims, unique=True)
    return day_layout(built, "date_sk") if None in sent else built


def _sent(house: Warehouse, name: str) -> DataFrame | Sent | None:
    """A dimension as it is sent to all tasks, if it is small enough; the driver holds it too."""
    given = house.load.last_keys.get(name, house.load.last.last_keys.get(name, 0))
    if given > SENT_KEYS:
        return None
    if given <= SENT_ROWS:
        return F.broadcast(house.read(name))
    return sent_keys(house.read(name), *KEYS[name].names) if name in KEYS else None


def _rebuild_movement(house: Warehouse, days: set[int | None]) -> None:
    """The movement of all days: sums of the touched days anew, those of the others as stored."""
    if not house.load.has("movement_sums"):
        days = _distinct_days(_silver(house, "vehicle_positions"))
    if days:
        sums = facts.movement_sums(_silver(house, "vehicle_positions", days))
        house.load.replace_folders(
            "movement_sums", sums, MOVEMENT_SUMS, "date_sk", [label(day) for day in days]
        )
    sums = house.load.read("movement_sums", MOVEMENT_SUMS)
    house.keep("fact_vehicle_movement", facts.movement_of(sums, house.read("dim_route")))
