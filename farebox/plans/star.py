"""Which table is built from which."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from farebox.operators import dimensions, facts, marts, scd2
from farebox.schemas import (
    DASHBOARD_DAILY,
    DIM_DATE,
    DIM_ROUTE,
    DIM_USER,
    DIM_VEHICLE,
    FACT_PAYMENTS,
    FACT_RIDES,
    FACT_VEHICLE_MOVEMENT,
    USER_BEHAVIOR_HOURLY,
)

SCHEMAS = {
    "dim_user": DIM_USER,
    "dim_route": DIM_ROUTE,
    "dim_vehicle": DIM_VEHICLE,
    "dim_date": DIM_DATE,
    "fact_rides": FACT_RIDES,
    "fact_payments": FACT_PAYMENTS,
    "fact_vehicle_movement": FACT_VEHICLE_MOVEMENT,
    "user_behavior_hourly": USER_BEHAVIOR_HOURLY,
    "dashboard_daily": DASHBOARD_DAILY,
}


class Star:
    """The star schema and its marts over raw entities.

    ``raw`` returns an entity by name. ``keep`` receives each table once, before
    the first one built from it, and returns what to build from: a scan of the
    written table in a load, so that dimensions have known sizes and are computed
    once, or the frame itself. ``routes`` holds the route versions known so far.
    Entities are ``cleaned`` if they have one row for each key and none without.
    """

    def __init__(
        self,
        raw: Callable[[str], DataFrame],
        keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
        as_of: dt.date | None = None,
        cleaned: bool = False,
        route_versions: Callable[[DataFrame], DataFrame] | None = None,
        known_keys: Callable[[str], tuple[DataFrame | None, int]] = lambda name: (None, 0),
    ):
        self.raw = raw
        self.keep = keep
        self.as_of = as_of
        self.cleaned = cleaned
        self.route_versions = route_versions or self._first_versions
        self.known_keys = known_keys
        self.kept: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The kept table."""
        if name not in self.kept:
            self.kept[name] = self.keep(name, self.build(name))
        return self.kept[name]

    def build(self, name: str) -> DataFrame:
        """The table computed from the kept tables it depends on."""
        return getattr(self, f"_{name}")()

    def _dim_user(self) -> DataFrame:
        known = self.known_keys("dim_user")
        return dimensions.build_dim_user(self.raw("users"), self.cleaned, *known)

    def _dim_vehicle(self) -> DataFrame:
        known = self.known_keys("dim_vehicle")
        return dimensions.build_dim_vehicle(self.raw("vehicles"), self.cleaned, *known)

    def _dim_route(self) -> DataFrame:
        return self.route_versions(self.raw("routes"))

    def _first_versions(self, snapshot: DataFrame) -> DataFrame:
        none = snapshot.sparkSession.createDataFrame([], DIM_ROUTE)
        return scd2.merge_routes(none, snapshot, self.as_of)

    def _dim_date(self) -> DataFrame:
        return dimensions.build_dim_date(
            self.raw("rides").select("start_time"), self.raw("payments").select("created_at")
        )

    def _fact_rides(self) -> DataFrame:
        return facts.build_fact_rides(
            self.raw("rides"),
            self.table("dim_user"),
            self.table("dim_route"),
            self.table("dim_vehicle"),
            self.cleaned,
        )

    def _fact_payments(self) -> DataFrame:
        return facts.build_fact_payments(
            self.raw("payments"), self.table("dim_user"), self.cleaned
        )

    def _fact_vehicle_movement(self) -> DataFrame:
        return facts.build_fact_vehicle_movement(
            self.raw("vehicle_positions"), self.table("dim_route")
        )

    def _user_behavior_rides(self) -> DataFrame:
        return marts.user_behavior_rides(
            self.table("fact_rides"),
            self.table("dim_user"),
            self.table("dim_route"),
            self.table("dim_date"),
        )

    def _user_behavior_payments(self) -> DataFrame:
        return marts.user_behavior_payments(
            self.table("fact_payments"),
            self.table("fact_rides"),
            self.table("dim_user"),
            self.table("dim_route"),
            self.table("dim_date"),
        )

    def _user_behavior_hourly(self) -> DataFrame:
        return marts.user_behavior_hourly(
            self.table("fact_rides"),
            self.table("fact_payments"),
            self.table("dim_user"),
            self.table("dim_route"),
            self.table("dim_date"),
        )

    def _dashboard_daily(self) -> DataFrame:
        return marts.dashboard_daily(
            self.table("fact_rides"),
            self.table("dim_route"),
            self.table("dim_vehicle"),
            self.table("dim_date"),
        )
