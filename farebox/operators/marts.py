"""Data marts: hourly user behaviour and the daily dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.amounts import amount, hundredths, rounded_mean, truncated_mean
from farebox.operators.scd2 import current_rows
from farebox.schemas import DASHBOARD_DAILY, TOTAL, USER_BEHAVIOR_HOURLY, conform

CELL = [
    "full_date",
    "hour_of_day",
    "day_of_week",
    "city",
    "user_id",
    "route_number",
    "vehicle_type",
]
MEASURES = [
    "total_rides",
    "total_revenue",
    "avg_duration_seconds",
    "avg_fare",
    "total_payments",
    "successful_payments",
]


def _describe(
    events: DataFrame, dim_user: DataFrame, dim_route: DataFrame, dim_date: DataFrame, moment: str
) -> DataFrame:
    """Add the attributes of an hourly cell; unknown users, routes and days drop out.

    Users come last: they are the one dimension likely to be shuffled, and with
    them the events left by then. Adaptive execution splits a frequent traveller's
    partition, and each task adds up its own events before the next shuffle.
    Adding up before this join as well took a fifth longer even with a third of
    20 million rides by one user: few events share an hour, a route and a user.
    """
    routes = current_rows(dim_route).select("route_sk", "route_number", "vehicle_type")
    return (
        events.join(routes, "route_sk")
        .join(dim_date.select("date_sk", "full_date"), "date_sk")
        .join(dim_user.select("user_sk", "user_id", "city"), "user_sk")
        .withColumns({"hour_of_day": F.hour(moment), "day_of_week": F.dayofweek(moment)})
    )


def _ride_sums(fact_rides: DataFrame, *keys) -> DataFrame:
    return fact_rides.groupBy(*keys).agg(
        F.count("ride_id").alias("rides"),
        F.sum(hundredths(F.col("fare_amount"))).alias("fare_sum"),
        F.count("fare_amount").alias("fare_count"),
        F.sum("ride_duration_sec").alias("duration_sum"),
        F.count("ride_duration_sec").alias("duration_count"),
    )


def user_behavior_rides(
    fact_rides: DataFrame, dim_user: DataFrame, dim_route: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Ride measures per cell; a ride counts in the hour it starts."""
    rides = _describe(fact_rides, dim_user, dim_route, dim_date, "start_time")
    return _ride_sums(rides, *CELL).select(
        *CELL,
        F.col("rides").alias("total_rides"),
        amount(F.col("fare_sum"), TOTAL).alias("total_revenue"),
        truncated_mean(F.col("duration_sum"), F.col("duration_count")).alias(
            "avg_duration_seconds"
        ),
        rounded_mean(F.col("fare_sum"), F.col("fare_count"), TOTAL).alias("avg_fare"),
    )


def user_behavior_payments(
    fact_payments: DataFrame,
    fact_rides: DataFrame,
    dim_user: DataFrame,
    dim_route: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Payment measures per cell and payment method, in the hour of payment.

    A payment belongs to the route of the ride it pays for.
    """
    payments = fact_payments.join(fact_rides.select("ride_id", "route_sk"), "ride_id")
    return (
        _describe(payments, dim_user, dim_route, dim_date, "created_at")
        .groupBy(*CELL, "payment_method")
        .agg(
            F.count(F.lit(1)).alias("total_payments"),
            F.count_if(F.col("status") == "success").alias("successful_payments"),
        )
    )


def user_behavior_hourly(
    fact_rides: DataFrame,
    fact_payments: DataFrame,
    dim_user: DataFrame,
    dim_route: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Rides and payments side by side per cell and payment method.

    The ride measures of a cell repeat on each of its payment methods. A cell
    with only rides has a null method, and cells with a null attribute, such as
    an unknown city, never meet. Missing measures are 0.
    """
    rides = user_behavior_rides(fact_rides, dim_user, dim_route, dim_date)
    payments = user_behavior_payments(fact_payments, fact_rides, dim_user, dim_route, dim_date)
    return conform(
        rides.join(payments, CELL, "full_outer").fillna(0, subset=MEASURES), USER_BEHAVIOR_HOURLY
    )


def dashboard_daily(
    fact_rides: DataFrame, dim_route: DataFrame, dim_vehicle: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Rides, revenue, mean duration and mean fare per day, route and vehicle type.

    Rides are added up by their keys first: what meets the vehicles, which may be
    too many to broadcast, are sums per day and vehicle.
    """
    routes = current_rows(dim_route).select("route_sk", "route_number", "vehicle_type")
    described = (
        _ride_sums(fact_rides, "date_sk", "route_sk", "vehicle_sk")
        .join(routes, "route_sk")
        .join(dim_vehicle.select("vehicle_sk"), "vehicle_sk")
        .join(dim_date.select("date_sk", "full_date"), "date_sk")
    )
    fares = F.sum("fare_sum")
    daily = described.groupBy("full_date", "route_number", "vehicle_type").agg(
        F.sum("rides").alias("total_rides"),
        amount(fares, TOTAL).alias("total_revenue"),
        rounded_mean(F.sum("duration_sum") * 100, F.sum("duration_count"), TOTAL).alias(
            "avg_duration_seconds"
        ),
        rounded_mean(fares, F.sum("fare_count"), TOTAL).alias("avg_fare"),
    )
    return conform(daily, DASHBOARD_DAILY)
