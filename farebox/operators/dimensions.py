"""Dimension tables: users, vehicles, calendar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farebox.functions.dates import date_sk
from farebox.operators.keys import assign_surrogate_key, keep_surrogate_keys
from farebox.schemas import DIM_DATE, DIM_USER, DIM_VEHICLE, conform


def build_dim_user(
    users: DataFrame, unique: bool = False, known: DataFrame | None = None, after: int = 0
) -> DataFrame:
    """Users with ``user_sk``. A user_id delivered twice stays two rows.

    Cleaned users are ``unique``: one row for each user_id, none without. They keep the keys
    ``known`` from earlier loads, if given, and new users get those after ``after``.
    """
    return _dimension(users, DIM_USER, "user_id", unique, known, after)


def build_dim_vehicle(
    vehicles: DataFrame, unique: bool = False, known: DataFrame | None = None, after: int = 0
) -> DataFrame:
    """Vehicles with ``vehicle_sk``, without the route they run on; otherwise as users."""
    return _dimension(vehicles, DIM_VEHICLE, "vehicle_id", unique, known, after)


def _dimension(
    rows: DataFrame,
    schema: StructType,
    key: str,
    unique: bool,
    known: DataFrame | None,
    after: int,
) -> DataFrame:
    sk, *columns = schema.names
    named = rows.select(*columns)
    if known is None:
        return conform(assign_surrogate_key(named, key, sk, after, unique), schema)
    return conform(keep_surrogate_keys(named, known, key, sk, after), schema)


def build_dim_date(*moments: DataFrame) -> DataFrame:
    """Every day from the first to the last moment found in the given columns.

    Each argument is a frame of one date or timestamp column. Only the smallest
    and largest value of each are brought together.
    """
    spans = [
        m.agg(F.min(m.columns[0]).alias("first"), F.max(m.columns[0]).alias("last"))
        for m in moments
    ]
    span = reduce(DataFrame.unionByName, spans).agg(
        F.min("first").cast("date").alias("first"), F.max("last").cast("date").alias("last")
    )
    full_date = F.col("full_date")
    calendar = span.select(F.explode(F.sequence("first", "last")).alias("full_date")).withColumns(
        {
            "date_sk": date_sk(full_date),
            "year": F.year(full_date),
            "month": F.month(full_date),
            "day": F.dayofmonth(full_date),
            "day_of_week": F.dayofweek(full_date),
        }
    )
    return conform(calendar, DIM_DATE)
