"""Slowly changing dimensions that keep every version of a row."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from farebox.functions.checks import must
from farebox.functions.dates import OPEN_END, day_or_today
from farebox.operators.keys import assign_surrogate_key
from farebox.schemas import DIM_ROUTE, RAW, conform
from farebox.session import cut_lineage


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("is_current"))


def merged_versions(
    current: DataFrame,
    states: DataFrame,
    key: str,
    tracked: list[str],
    sk: str,
    after: Column | int,
) -> DataFrame:
    """The ``current`` versions brought up to one or more dated snapshots, in one pass.

    ``states`` are the rows of the snapshots with the day of each in ``valid_from``. Per
    business ``key``, in the order of the days:

    * not seen before: a version valid from that day on;
    * a ``tracked`` column differs, null being a value: the version before ends the day
      before and a new one starts. A current version begun on the same day is changed in
      place, so a version never ends before it starts;
    * equal, or missing from the snapshot: the version before goes on.

    So each run of equal states, its gaps included, is one version, and a number of snapshots
    merged at once give what they give one after another. Versions that are closed already
    are neither needed nor read. Surrogate keys never change, and new versions get the ones
    after ``after``, by day and key. A snapshot with a null or repeated key, or older than a
    current version, is an error, and so are two current versions of one key: they are found
    right here, where the result is checkpointed. Returns open versions and those closed.
    """
    stored = F.col(sk).isNotNull()
    state = F.struct(*tracked)
    rows = (
        states.filter(must(F.col(key).isNotNull(), "the snapshot has a null business key"))
        .select(F.lit(None).cast("int").alias(sk), key, *tracked, "valid_from")
        .unionByName(current.select(sk, key, *tracked, "valid_from"))
    )
    # All windows share one shuffle and one sort.
    by_day = Window.partitionBy(key).orderBy("valid_from", stored.desc())
    in_order = rows.withColumns(
        {
            "_place": F.row_number().over(by_day),
            "_same_day": F.lag("valid_from").over(by_day) == F.col("valid_from"),
            "_after_stored": F.lag(stored).over(by_day),
            "_amended": F.lead("valid_from").over(by_day) == F.col("valid_from"),
            "_next": F.lead(state).over(by_day),
        }
    )
    amended = stored & F.coalesce("_amended", F.lit(False))
    amending = F.coalesce(F.col("_same_day") & F.col("_after_stored"), F.lit(False))
    valid = in_order.filter(
        must(
            ~stored | (F.col("_place") == 1) | ~F.col("_after_stored"),
            "a business key has two current versions",
        )
    )
    valid = valid.filter(
        must(
            ~stored | (F.col("_place") == 1) | F.col("_after_stored"),
            "the snapshot is older than a current version",
        )
    )
    valid = valid.filter(
        must(
            F.coalesce(~F.col("_same_day"), F.lit(True)) | F.col("_after_stored"),
            "the snapshot repeats a business key",
        )
    )
    states_then = valid.withColumn(
        "_state", F.when(amended, F.col("_next")).otherwise(state)
    ).filter(~amending)
    begun = _begun(states_then, by_day)
    closed_by = F.lead("valid_from").over(by_day)
    versions = begun.select(
        sk,
        key,
        *[F.col(f"_state.{c}").alias(c) for c in tracked],
        "valid_from",
        F.coalesce(F.date_sub(closed_by, 1), F.lit(OPEN_END)).alias("valid_to"),
        closed_by.isNull().alias("is_current"),
    )
    # Computed once: versions kept, and twice the new ones, are read from here.
    versions = cut_lineage(versions)
    opened = versions.filter(F.col(sk).isNull()).drop(sk)
    given = assign_surrogate_key(opened, key, sk, after, unique=True, first="valid_from")
    return versions.filter(stored).unionByName(given)


def _begun(states: DataFrame, by_day: WindowSpec) -> DataFrame:
    """The rows that differ from the one before, and the first of each key."""
    compared = states.withColumns(
        {"_before": F.lag("_state").over(by_day), "_first": F.row_number().over(by_day) == 1}
    )
    return compared.filter(F.col("_first") | ~F.col("_state").eqNullSafe(F.col("_before")))


def scd2_merge(
    existing: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: list[str],
    sk: str,
    as_of: dt.date | None = None,
) -> DataFrame:
    """All versions of ``existing`` brought up to ``snapshot`` as of a day (default: today).

    See ``merged_versions``. Closed versions pass through.
    """
    states = snapshot.select(key, *tracked, day_or_today(as_of).alias("valid_from"))
    last_sk = existing.agg(F.coalesce(F.max(sk), F.lit(0))).scalar()
    merged = merged_versions(current_rows(existing), states, key, tracked, sk, last_sk)
    history = existing.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    return history.select(*merged.columns).unionByName(merged)


TRACKED_ROUTE = ["route_number", "vehicle_type", "base_fare"]


def merge_routes(
    existing: DataFrame, snapshot: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """dim_route after loading a snapshot of the raw routes."""
    routes = conform(snapshot, RAW["routes"])
    merged = scd2_merge(existing, routes, "route_id", TRACKED_ROUTE, "route_sk", as_of)
    return conform(merged, DIM_ROUTE)


def merge_route_snapshots(
    current: DataFrame, snapshots: dict[dt.date, DataFrame], after: Column | int
) -> DataFrame:
    """The open versions of dim_route after snapshots of some days, and those closed by them."""
    states = reduce(
        DataFrame.unionByName,
        [
            conform(routes, RAW["routes"]).withColumn("valid_from", F.lit(day))
            for day, routes in snapshots.items()
        ],
    )
    merged = merged_versions(current, states, "route_id", TRACKED_ROUTE, "route_sk", after)
    return conform(merged, DIM_ROUTE)
