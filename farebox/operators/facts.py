"""Fact tables: rides, payments, vehicle movement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.amounts import hundredths, rounded_mean, truncated_mean
from farebox.functions.dates import date_sk, seconds_between
from farebox.operators.keys import Sent, lookup_sk
from farebox.operators.scd2 import current_rows
from farebox.schemas import (
    FACT_PAYMENTS,
    FACT_RIDES,
    FACT_VEHICLE_MOVEMENT,
    conform,
)


def build_fact_rides(
    rides: DataFrame,
    dim_user: DataFrame | Sent,
    dim_route: DataFrame,
    dim_vehicle: DataFrame | Sent,
    unique: bool = False,
) -> DataFrame:
    """Rides with their dimension keys, duration and day.

    Routes are looked up in their current version. A ride whose user, route or
    vehicle is unknown stays, with a null key. ``unique`` as in ``lookup_sk``.
    """
    keyed = lookup_sk(rides, current_rows(dim_route), "route_id", "route_sk", unique)
    keyed = lookup_sk(keyed, dim_vehicle, "vehicle_id", "vehicle_sk", unique)
    keyed = lookup_sk(keyed, dim_user, "user_id", "user_sk", unique)
    start, end = F.col("start_time"), F.col("end_time")
    return conform(
        keyed.withColumns(
            {"ride_duration_sec": seconds_between(start, end), "date_sk": date_sk(start)}
        ),
        FACT_RIDES,
    )


def build_fact_payments(
    payments: DataFrame, dim_user: DataFrame | Sent, unique: bool = False
) -> DataFrame:
    """Payments with the key of their user and the day they were made."""
    keyed = lookup_sk(payments, dim_user, "user_id", "user_sk", unique)
    return conform(keyed.withColumn("date_sk", date_sk(F.col("created_at"))), FACT_PAYMENTS)


def build_fact_vehicle_movement(positions: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Mean speed, mean load and number of position events per route and day.

    Positions are the largest input and one route may send most of them, so they
    are added up per route number and day before routes are looked up; the join
    and the second grouping see days times routes, not events.
    """
    return movement_of(movement_sums(positions), dim_route)


def movement_sums(positions: DataFrame) -> DataFrame:
    """Sums and counts per route number and day, which add up over any parts of the events."""
    return positions.groupBy("route_number", date_sk(F.col("event_time")).alias("date_sk")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(hundredths(F.col("speed_kmh"))).alias("speed_sum"),
        F.count("speed_kmh").alias("speed_count"),
        F.sum("passengers_estimated").alias("passenger_sum"),
        F.count("passengers_estimated").alias("passenger_count"),
    )


def movement_of(sums: DataFrame, dim_route: DataFrame, unique: bool = False) -> DataFrame:
    """fact_vehicle_movement from sums, under the current versions of the routes."""
    movement = (
        lookup_sk(sums, current_rows(dim_route), "route_number", "route_sk", unique)
        .groupBy("route_sk", "date_sk")
        .agg(
            rounded_mean(
                F.sum("speed_sum"),
                F.sum("speed_count"),
                FACT_VEHICLE_MOVEMENT["avg_speed"].dataType,
            ).alias("avg_speed"),
            truncated_mean(F.sum("passenger_sum"), F.sum("passenger_count")).alias(
                "avg_passengers"
            ),
            F.sum("events").alias("events_count"),
        )
    )
    return conform(movement, FACT_VEHICLE_MOVEMENT)
