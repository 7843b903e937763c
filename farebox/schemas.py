"""The declared contract: one StructType per table, and ``conform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

INT, LONG, STR = IntegerType(), LongType(), StringType()
TS, DAY, FLAG = TimestampNTZType(), DateType(), BooleanType()
MONEY = DecimalType(10, 2)
# Sums and means of money: a busy route's daily revenue does not fit MONEY, and
# Spark's ANSI mode turns an overflowing cast into an error.
TOTAL = DecimalType(18, 2)


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Raw zone, as the entities look once typed. The staging table of an entity has
# these columns plus load_ts.
RAW: dict[str, StructType] = {
    "users": _table(user_id=INT, name=STR, email=STR, city=STR, created_at=TS),
    "routes": _table(route_id=INT, route_number=STR, vehicle_type=STR, base_fare=MONEY),
    "vehicles": _table(vehicle_id=INT, route_id=INT, license_plate=STR, capacity=INT),
    "rides": _table(
        ride_id=STR,
        user_id=INT,
        route_id=INT,
        vehicle_id=INT,
        start_time=TS,
        end_time=TS,
        fare_amount=MONEY,
    ),
    "payments": _table(
        payment_id=STR,
        ride_id=STR,
        user_id=INT,
        amount=MONEY,
        payment_method=STR,
        status=STR,
        created_at=TS,
    ),
    "vehicle_positions": _table(
        event_id=STR,
        vehicle_id=INT,
        route_number=STR,
        event_time=TS,
        latitude=DecimalType(9, 6),
        longitude=DecimalType(9, 6),
        speed_kmh=DecimalType(5, 2),
        passengers_estimated=INT,
    ),
}

STAGING: dict[str, StructType] = {
    name: StructType([*schema.fields, StructField("load_ts", TS)]) for name, schema in RAW.items()
}

# Staged rows whose values were tried: the reasons why a row was rejected, none if it was not,
# and what a rejected row had, as JSON.
CHECKED: dict[str, StructType] = {
    name: StructType(
        [*schema.fields, StructField("reasons", ArrayType(STR)), StructField("delivered", STR)]
        + [StructField("accepted", FLAG)]
    )
    for name, schema in STAGING.items()
}
REJECTED = _table(reasons=ArrayType(STR), delivered=STR, load_ts=TS)

DIM_USER = _table(user_sk=INT, user_id=INT, name=STR, email=STR, city=STR, created_at=TS)
DIM_ROUTE = _table(
    route_sk=INT,
    route_id=INT,
    route_number=STR,
    vehicle_type=STR,
    base_fare=MONEY,
    valid_from=DAY,
    valid_to=DAY,
    is_current=FLAG,
)
DIM_VEHICLE = _table(vehicle_sk=INT, vehicle_id=INT, license_plate=STR, capacity=INT)
DIM_DATE = _table(date_sk=INT, full_date=DAY, year=INT, month=INT, day=INT, day_of_week=INT)

# The surrogate keys given to business keys by all loads so far.
KEYS = {
    "dim_user": _table(user_id=INT, user_sk=INT),
    "dim_vehicle": _table(vehicle_id=INT, vehicle_sk=INT),
}

FACT_RIDES = _table(
    ride_id=STR,
    user_sk=INT,
    route_sk=INT,
    vehicle_sk=INT,
    start_time=TS,
    end_time=TS,
    ride_duration_sec=INT,
    fare_amount=MONEY,
    date_sk=INT,
)
FACT_PAYMENTS = _table(
    payment_id=STR,
    ride_id=STR,
    user_sk=INT,
    amount=MONEY,
    payment_method=STR,
    status=STR,
    created_at=TS,
    date_sk=INT,
)
FACT_VEHICLE_MOVEMENT = _table(
    route_sk=INT,
    date_sk=INT,
    avg_speed=DecimalType(5, 2),
    avg_passengers=INT,
    events_count=LONG,
)

# What fact_vehicle_movement is made of, kept by day.
MOVEMENT_SUMS = _table(
    route_number=STR,
    date_sk=INT,
    events=LONG,
    speed_sum=LONG,
    speed_count=LONG,
    passenger_sum=LONG,
    passenger_count=LONG,
)

USER_BEHAVIOR_HOURLY = _table(
    full_date=DAY,
    hour_of_day=INT,
    day_of_week=INT,
    city=STR,
    user_id=INT,
    route_number=STR,
    vehicle_type=STR,
    payment_method=STR,
    total_rides=LONG,
    total_revenue=TOTAL,
    avg_duration_seconds=INT,
    avg_fare=TOTAL,
    total_payments=LONG,
    successful_payments=LONG,
)
DASHBOARD_DAILY = _table(
    full_date=DAY,
    route_number=STR,
    vehicle_type=STR,
    total_rides=LONG,
    total_revenue=TOTAL,
    avg_duration_seconds=TOTAL,
    avg_fare=TOTAL,
)
QUALITY_LOG = _table(check_date=TS, table_name=STR, check_type=STR, result_value=STR, status=STR)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s columns from ``df`` in order, cast to its types.

    A column the schema asks for and the frame lacks is an error; further
    columns are dropped. Casts follow the session's ANSI setting, so a value
    that does not fit its declared type fails the job.
    """
    require(df, schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def require(df: DataFrame, schema: StructType) -> None:
    """An error if ``df`` lacks a column of ``schema``."""
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
