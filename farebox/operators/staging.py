"""Raw tables to typed staging tables, and staging to clean ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.dates import moment_or_now
from farebox.schemas import RAW, conform, require

# Business key of each entity to be cleaned, and the column telling its deliveries apart.
BUSINESS_KEYS = {
    "users": ("user_id", "created_at"),
    "routes": ("route_id", None),
    "vehicles": ("vehicle_id", None),
    "rides": ("ride_id", "end_time"),
    "payments": ("payment_id", "created_at"),
    "vehicle_positions": ("event_id", "event_time"),
}

# The moment that a fact's day is taken from, for entities that are kept by day.
DAY_OF = {"rides": "start_time", "payments": "created_at", "vehicle_positions": "event_time"}


def load_staging(raw: DataFrame, table: str, load_ts: dt.datetime | None = None) -> DataFrame:
    """``raw`` in the types of staging table ``table``, stamped with ``load_ts``."""
    return conform(raw, RAW[table]).withColumn("load_ts", moment_or_now(load_ts))


def check_types(raw: DataFrame, table: str, load_ts: dt.datetime | None = None) -> DataFrame:
    """``load_staging`` for deliveries whose values may not fit, which are not an error.

    Every row comes out. Where a value does not fit its declared type, ``accepted`` is false,
    ``reasons`` has the columns and their types, and ``delivered`` the row as JSON, its values
    as text.
    """
    schema = RAW[table]
    require(raw, schema)
    fitted = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    reasons = [
        F.when(
            F.col(f.name).isNotNull() & fitted[f.name].isNull(),
            F.lit(f"{f.name} is no {f.dataType.simpleString()}"),
        )
        for f in schema
    ]
    texts = F.struct(*[F.col(f.name).cast("string").alias(f.name) for f in schema])
    checked = raw.select(
        *[value.alias(name) for name, value in fitted.items()],
        moment_or_now(load_ts).alias("load_ts"),
        F.array_compact(F.array(*reasons)).alias("reasons"),
        F.to_json(texts, {"ignoreNullFields": "false"}).alias("_texts"),
    ).withColumn("accepted", F.size("reasons") == 0)
    delivered = F.when(~F.col("accepted"), F.col("_texts"))
    return checked.withColumn("delivered", delivered).drop("_texts")


def bronze_to_silver(
    df: DataFrame, key: str, event_time: str | None = None, within: tuple[str, ...] = ()
) -> DataFrame:
    """One row per non-null ``key``, and per ``within`` if given: the latest by ``event_time``.

    Rows equal in time, or all rows where there is none, are told apart by their
    remaining columns in order, so the outcome does not depend on the input's.
    Each task reduces its own rows to one per key before anything is shuffled, by
    sorting them, as a struct's maximum has no hash aggregate; a key repeated without
    end costs no more than any other.
    """
    by = (*within, key)
    others = [c for c in df.columns if c not in (*by, event_time)]
    ranking = others if event_time is None else [event_time, *others]
    latest = (
        df.filter(F.col(key).isNotNull())
        .groupBy(*by)
        .agg(F.max(F.struct(*ranking)).alias("latest"))
    )
    return latest.select(*[c if c in by else F.col(f"latest.{c}").alias(c) for c in df.columns])


def clean(raw: DataFrame, table: str) -> DataFrame:
    """``bronze_to_silver`` of a raw entity under its declared types and key."""
    return bronze_to_silver(conform(raw, RAW[table]), *BUSINESS_KEYS[table])


def cleaning_findings(raw: DataFrame, table: str) -> dict[str, int]:
    """How many rows of a raw entity there are, and how many have no key.

    In an aggregate of its own, which reads the key column alone: counting on the way through
    another job would count a task that runs again twice.
    """
    key = BUSINESS_KEYS[table][0]
    return (
        conform(raw, RAW[table])
        .agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls")
        )
        .first()
        .asDict()
    )
