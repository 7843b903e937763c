"""Raw transit tables derived from the driver's test tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators.keys import lookup_bounded
from farebox.schemas import MONEY, RAW, conform

# The clock of the fixtures.
LOAD_TS = dt.datetime(2024, 1, 9, 2, 0)
CHECK_TS = dt.datetime(2024, 1, 9, 3, 0)
FIRST_LOAD = dt.date(2024, 1, 1)
SECOND_LOAD = dt.date(2024, 2, 1)
THIRD_LOAD = dt.date(2024, 3, 1)
NEXT_LOAD_TS = dt.datetime(2024, 1, 10, 2, 0)
FIRST_DAYS = dt.date(2024, 1, 4)
MAX_LAG_SECONDS = 86_400


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city")
    )
    key = F.col("c_custkey")
    return (
        _table(spark, sf_dir, "customer")
        .join(nation, "c_nationkey")
        .select(
            key.alias("user_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@example.com")).alias(
                "email"
            ),
            "city",
            F.timestamp_add("SECOND", key.cast("int"), _moment("2023-01-01 00:00:00")).alias(
                "created_at"
            ),
        )
    )


def redelivered_users(once: DataFrame) -> DataFrame:
    """Users, a tenth of them once more a day later, and some without an id."""
    again = once.filter(F.col("user_id") % 10 == 0).withColumns(
        {
            "created_at": F.timestamp_add("DAY", F.lit(1), F.col("created_at")),
            "city": F.lit("MOVED"),
        }
    )
    nameless = once.filter(F.col("user_id") % 50 == 1).withColumn(
        "user_id", F.lit(None).cast("int")
    )
    return once.unionByName(again).unionByName(nameless)


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "part")
        .groupBy("p_brand")
        .agg(
            F.min_by("p_type", "p_partkey").alias("vehicle_type"),
            F.min("p_retailprice").alias("base_fare"),
        )
        .select(
            _brand_number().alias("route_id"),
            F.col("p_brand").alias("route_number"),
            "vehicle_type",
            "base_fare",
        )
    )


def changed_routes(routes: DataFrame) -> DataFrame:
    """The next snapshot: some fares raised, route 25 gone, route 26 added."""
    fare = F.col("base_fare")
    raised = F.when(F.col("route_id") % 5 == 0, fare + F.lit("5.00").cast(MONEY)).otherwise(fare)
    later = routes.filter(F.col("route_id") != 25).withColumn("base_fare", raised.cast(MONEY))
    added = later.sparkSession.sql(
        "SELECT 26 AS route_id, 'Brand#26' AS route_number, 'metro' AS vehicle_type, "
        "CAST(60 AS DECIMAL(10,2)) AS base_fare"
    )
    return later.unionByName(added)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _table(spark, sf_dir, "supplier").select(
        key.alias("vehicle_id"),
        (1 + key % 25).alias("route_id"),
        F.col("s_name").alias("license_plate"),
        (50 + key % 71).alias("capacity"),
    )


def _ride_times() -> dict[str, F.Column]:
    key = F.col("o_orderkey")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit(dt.date(1995, 1, 1))) % 7
    second = key * 7919 % 86400
    start = F.timestamp_add(
        "SECOND", (day * 86400 + second).cast("int"), _moment("2024-01-01 00:00:00")
    )
    return {
        "start_time": start,
        "end_time": F.timestamp_add("MINUTE", (5 + key % 86).cast("int"), start),
    }


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("line"))
        .select(
            "o_orderkey",
            F.col("line.l_partkey").alias("p_partkey"),
            F.col("line.l_suppkey").alias("vehicle_id"),
        )
    )
    brand = _table(spark, sf_dir, "part").select("p_partkey", _brand_number().alias("route_id"))
    ordered = _table(spark, sf_dir, "orders").join(line, "o_orderkey", "left")
    return (
        lookup_bounded(ordered, brand, "p_partkey", "route_id")
        .withColumns(_ride_times())
        .select(
            F.col("o_orderkey").cast("string").alias("ride_id"),
            (F.col("o_custkey") % 20).alias("user_id"),
            "route_id",
            "vehicle_id",
            "start_time",
            "end_time",
            F.col("o_totalprice").cast(MONEY).alias("fare_amount"),
        )
    )


def redelivered_rides(once: DataFrame) -> DataFrame:
    """Rides, a twentieth of them once more with a later end."""
    again = once.filter(F.col("ride_id").cast("bigint") % 20 == 0).withColumn(
        "end_time", F.timestamp_add("MINUTE", F.lit(1), F.col("end_time"))
    )
    return once.unionByName(again)


def redelivered_payments(once: DataFrame) -> DataFrame:
    """Payments, a twentieth of them once more a minute later and settled."""
    again = once.filter(F.col("ride_id").cast("bigint") % 20 == 0).withColumns(
        {
            "created_at": F.timestamp_add("MINUTE", F.lit(1), F.col("created_at")),
            "status": F.lit("success"),
        }
    )
    return once.unionByName(again)


def redelivered_positions(once: DataFrame) -> DataFrame:
    """Positions, all of them delivered twice, and some without an id."""
    nameless = once.filter(F.col("vehicle_id") % 50 == 1).withColumn(
        "event_id", F.lit(None).cast("string")
    )
    return once.unionByName(once).unionByName(nameless)


def redelivered_copies(once: DataFrame) -> DataFrame:
    """Every row twice."""
    return once.unionByName(once)


def faulty_payments(once: DataFrame) -> DataFrame:
    """Payments as text, some with an amount, a moment or a user that is none, or with two."""
    number = F.col("ride_id").cast("bigint")
    text = once.select(*[F.col(c).cast("string").alias(c) for c in once.columns])
    return text.withColumns(
        {
            "amount": F.when(number % 10 == 3, "n/a").otherwise(F.col("amount")),
            "created_at": F.when(number % 15 == 3, "yesterday").otherwise(F.col("created_at")),
            "user_id": F.when(number % 25 == 5, "99999999999").otherwise(F.col("user_id")),
        }
    )


def split_deliveries(
    spark: SparkSession, sf_dir: str, stored: dict[str, DataFrame] | None = None
) -> list[dict[str, DataFrame]]:
    """What two nights deliver; raw entities already ``stored`` are not derived again.

    The first lacks a third of the users and all but the first days' rides and payments; of
    these days, every tenth is late. The second brings the rest, late rows of the first days
    among it, and every twentieth ride and payment once more, corrected.
    """
    every = {entity: raw(spark, sf_dir, entity) for entity in ENTITIES} | (stored or {})
    late = F.col("ride_id").cast("bigint") % 10 == 7
    again = F.col("ride_id").cast("bigint") % 20 == 0
    early = {
        "rides": F.to_date("start_time") <= FIRST_DAYS,
        "payments": F.to_date("created_at") <= FIRST_DAYS,
    }
    corrected = {
        "rides": redelivered_rides(every["rides"]),
        "payments": redelivered_payments(every["payments"]),
    }
    known = F.col("user_id") % 3 != 0
    first = {**every, "users": every["users"].filter(known)}
    second = {"users": every["users"].filter(~known)}
    for entity, is_early in early.items():
        first[entity] = every[entity].filter(is_early & ~late)
        second[entity] = every[entity].filter(~is_early | late).unionByName(
            corrected[entity].filter(again)
        )
    return [first, second]


# The raw zone of a night on which feeds repeat themselves.
REDELIVERED = {
    "users": redelivered_users,
    "rides": redelivered_rides,
    "payments": redelivered_payments,
    "vehicle_positions": redelivered_positions,
    "routes": redelivered_copies,
    "vehicles": redelivered_copies,
}


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return (
        _table(spark, sf_dir, "orders")
        .withColumns(_ride_times())
        .select(
            F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("payment_id"),
            F.col("o_orderkey").cast("string").alias("ride_id"),
            (F.col("o_custkey") % 20).alias("user_id"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
            F.col("o_orderpriority").alias("payment_method"),
            F.when(status == "F", "success")
            .when(status == "O", "pending")
            .when(status == "P", "failed")
            .alias("status"),
            F.col("end_time").alias("created_at"),
        )
    )


def vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    place = RAW["vehicle_positions"]["latitude"].dataType
    return _table(spark, sf_dir, "events").select(
        event.cast("string").alias("event_id"),
        user.alias("vehicle_id"),
        F.concat(F.lit("Brand#"), (1 + user % 25).cast("string")).alias("route_number"),
        F.col("ts").alias("event_time"),
        (55 + (user % 100).cast("decimal(6,3)") / 1000).cast(place).alias("latitude"),
        (37 + (event % 100).cast("decimal(6,3)") / 1000).cast(place).alias("longitude"),
        F.col("value").cast("decimal(5,2)").alias("speed_kmh"),
        F.get_json_object("props", "$.k").cast("int").alias("passengers_estimated"),
    )


# The raw zone: one entry per entity.
ENTITIES = {
    "users": users,
    "routes": routes,
    "vehicles": vehicles,
    "rides": rides,
    "payments": payments,
    "vehicle_positions": vehicle_positions,
}


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A raw entity in its declared types."""
    return conform(ENTITIES[table](spark, sf_dir), RAW[table])


def _brand_number() -> F.Column:
    return F.substring("p_brand", 7, 10).cast("int")


def _moment(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")
