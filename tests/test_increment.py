import datetime as dt
import os
from decimal import Decimal

import pytest
from helpers import collected

from farebox.plans import increment
from farebox.plans.increment import run_increment
from farebox.plans.nightly import Warehouse, run_pipeline
from farebox.plans.star import SCHEMAS
from farebox.schemas import RAW
from farebox.sources.store import Store

NIGHTS = [dt.datetime(2024, 1, day, 2) for day in (5, 6, 7, 8)]


def at(day, hour=8, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def ride(name, user, route, vehicle, day, minutes=10):
    end = at(day) + dt.timedelta(minutes=minutes)
    return (name, user, route, vehicle, at(day), end, Decimal("45.00"))


def payment(name, ride_id, user, day, status="success"):
    return (name, ride_id, user, Decimal("45.00"), "card", status, at(day, 9))


def position(name, number, day, speed):
    return (name, 1, number, at(day), Decimal("55.1"), Decimal("37.1"), Decimal(speed), 20)


def user(number):
    return (number, f"U{number}", f"u{number}@x", "X", at(1))


ROUTES = [(1, "A", "bus", Decimal("40.00")), (2, "B", "tram", Decimal("45.00"))]
FIRST = {
    "users": [user(10), user(30)],
    "routes": ROUTES,
    "vehicles": [(7, 1, "P7", 50)],
    "rides": [
        ride("r1", 10, 1, 7, 1), ride("r2", 20, 2, 7, 2), ride("r3", 30, 1, 8, 3),
        ride("r4", 10, 2, 7, 4), ("r0", 10, 1, 7, None, None, None),
    ],
    "payments": [payment("p1", "r1", 10, 1), payment("p2", "r2", 20, 2), payment("p3", "r3", 30, 3)],
    "vehicle_positions": [position("e1", "A", 1, "30.0"), position("e2", "B", 2, "20.0")],
}


@pytest.fixture
def house(spark, tmp_path):
    """A warehouse that nights are loaded into, and what each of them rebuilt."""

    class House:
        root = str(tmp_path / "w")
        store = Store(spark, root)
        loaded = []
        every = {}

        def night(self, **delivered):
            number = len(self.loaded)
            folder = f"{tmp_path}/night{number}"
            for entity, values in delivered.items():
                frame = spark.createDataFrame(values, RAW[entity])
                frame.write.parquet(f"{folder}/{entity}")
                earlier = [] if entity == "routes" else self.every.get(entity, [])
                self.every[entity] = earlier + values
            self.loaded.append(run_increment(spark, folder, self.root, load_ts=NIGHTS[number]))
            return self.loaded[-1]

        def fact(self, name):
            return collected(self.store.read(name, SCHEMAS[name]))

        def named(self, name):
            """A fact with business keys in place of surrogate keys."""
            return collected(_named(self.store, name))

        def whole(self, name):
            """The same of one load of all deliveries."""
            for entity, values in self.every.items():
                frame = spark.createDataFrame(values, RAW[entity])
                frame.write.mode("overwrite").parquet(f"{tmp_path}/all/{entity}")
            root = f"{tmp_path}/whole{len(os.listdir(tmp_path))}"
            run_pipeline(spark, f"{tmp_path}/all", root, load_ts=NIGHTS[0], tables=[name], stage=False)
            return collected(_named(Store(spark, root), name))

    house = House()
    house.loaded, house.every = [], {}
    house.night(**FIRST)
    return house


def _named(store, name):
    fact = store.read(name, SCHEMAS[name])
    for dim, sk, key in (
        ("dim_user", "user_sk", "user_id"),
        ("dim_route", "route_sk", "route_id"),
        ("dim_vehicle", "vehicle_sk", "vehicle_id"),
    ):
        if sk in fact.columns:
            rows = store.read(dim, SCHEMAS[dim])
            if dim == "dim_route":
                rows = rows.filter("is_current")
            fact = fact.join(rows.select(sk, key), sk, "left").drop(sk)
    return fact.select(*sorted(fact.columns))


def test_the_first_delivery_is_a_whole_load(house):
    for name in ("fact_rides", "fact_payments", "fact_vehicle_movement"):
        assert house.named(name) == house.whole(name)
    assert [row[0] for row in house.fact("fact_rides")] == ["r0", "r1", "r2", "r3", "r4"]


def test_late_rows_touch_their_day_alone(house):
    before = house.store.state().parts("fact_rides")
    found = house.night(rides=[ride("r5", 30, 2, 7, 2), ride("r6", 10, 1, 7, 6)])
    assert found["fact_rides"] == [20240102, 20240106] and found["fact_payments"] == []
    after = house.store.state().parts("fact_rides")
    for day in (1, 3, 4):
        assert after[f"date_sk=2024010{day}"] == before[f"date_sk=2024010{day}"]
    assert after["date_sk=20240102"] != before["date_sk=20240102"]
    assert house.named("fact_rides") == house.whole("fact_rides")


def test_a_correction_may_move_a_ride(house):
    found = house.night(rides=[ride("r1", 10, 1, 7, 3, 99), ride("r0", 10, 1, 7, 1)])
    # r1 left the first day and came to the third, r0 had none.
    assert found["fact_rides"] == [20240101, 20240103, None]
    assert house.named("fact_rides") == house.whole("fact_rides")
    ids = [row[0] for row in house.fact("fact_rides")]
    assert sorted(ids) == ["r0", "r1", "r2", "r3", "r4"]
    assert "date_sk=__HIVE_DEFAULT_PARTITION__" not in house.store.state().parts("fact_rides")


def test_an_older_delivery_of_a_row_changes_nothing(house):
    before = house.named("fact_rides")
    house.night(rides=[ride("r4", 30, 1, 7, 4, 5)])
    assert house.named("fact_rides") == before == house.whole("fact_rides")


def test_new_users_and_vehicles_fill_earlier_days(house):
    found = house.night(users=[user(20)], vehicles=[(8, 1, "P8", 60)])
    assert found["fact_rides"] == [20240102, 20240103] and found["fact_payments"] == [20240102]
    assert house.named("fact_rides") == house.whole("fact_rides")
    assert house.named("fact_payments") == house.whole("fact_payments")
    users = dict(collected(house.store.read("dim_user", SCHEMAS["dim_user"]), "user_id", "user_sk"))
    assert users == {10: 1, 30: 2, 20: 3}


def test_changed_routes_get_their_rides(house):
    raised = [(1, "A", "bus", Decimal("41.00")), ROUTES[1]]
    found = house.night(routes=raised)
    assert found["fact_rides"] == [20240101, 20240103, None]
    current = {row[0]: row[2] for row in house.fact("fact_rides")}
    assert current["r1"] == 3 and current["r2"] == 2
    assert house.named("fact_rides") == house.whole("fact_rides")
    movement = house.fact("fact_vehicle_movement")
    assert {row[0] for row in movement} == {3, 2}


def test_movement_adds_up_over_nights(house):
    repeated = position("e1", "A", 1, "30.0")
    found = house.night(
        vehicle_positions=[repeated, position("e3", "A", 1, "50.0"), position("e4", None, 5, "9")]
    )
    assert found["fact_vehicle_movement"] == [20240101, 20240105]
    assert house.named("fact_vehicle_movement") == house.whole("fact_vehicle_movement")


def test_a_night_run_again_gives_the_same(spark, house, tmp_path):
    late = dict(rides=[ride("r5", 40, 2, 7, 2)], users=[user(5), user(40)])
    house.night(**late)
    tables = ("fact_rides", "dim_user", "fact_payments")
    before = [house.fact(name) for name in tables]
    run_increment(spark, f"{tmp_path}/night1", house.root, load_ts=NIGHTS[1])
    assert [house.fact(name) for name in tables] == before


def test_an_empty_delivery(spark, house, tmp_path):
    before = [house.fact(name) for name in ("fact_rides", "fact_payments", "fact_vehicle_movement")]
    os.mkdir(f"{tmp_path}/none")
    found = run_increment(spark, f"{tmp_path}/none", house.root, load_ts=NIGHTS[1])
    assert found == {"fact_rides": [], "fact_payments": [], "fact_vehicle_movement": []}
    assert before == [
        house.fact(name) for name in ("fact_rides", "fact_payments", "fact_vehicle_movement")
    ]


def test_a_delivery_that_breaks_off_changes_nothing(spark, house, tmp_path, monkeypatch):
    before = house.fact("fact_rides")

    def broken(*arguments):
        raise OSError("broke off")

    with monkeypatch.context() as patch:
        patch.setattr(increment, "_rebuild_movement", broken)
        with pytest.raises(OSError):
            house.night(rides=[ride("r9", 10, 1, 7, 2)])
    assert house.fact("fact_rides") == before


def test_only_touched_days_are_scanned(spark, house):
    warehouse = increment.Warehouse(spark, house.root, NIGHTS[1], NIGHTS[1].date())
    files = increment._silver(warehouse, "rides", {20240102}).inputFiles()
    assert files and all("date_sk=20240102" in file for file in files)


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_the_first_delivery_is_stored_as_it_was_cleaned(house):
    assert sorted(n for n in os.listdir(house.root) if n.startswith("delivered_")) == [
        "delivered_routes", "delivered_users", "delivered_vehicles",
    ]


def test_a_merge_brings_rows_together_by_day_and_a_fact_not_at_all(spark, house):
    warehouse = Warehouse(spark, house.root, NIGHTS[1], NIGHTS[1].date())
    stored = increment._silver(warehouse, "rides")
    plan = _plan(increment._latest_of_days(stored.unionByName(stored), "rides", None))
    assert "hashpartitioning(ride_id" not in plan and "REBALANCE" not in plan
    for fact, entity in (("fact_rides", "rides"), ("fact_payments", "payments")):
        plan = _plan(increment._fact_of(warehouse, fact, increment._silver(warehouse, entity)))
        assert "hashpartitioning" not in plan and "REBALANCE" not in plan


def test_dimensions_of_many_keys_are_sent_in_runs(spark, house, monkeypatch):
    monkeypatch.setattr(increment, "SENT_ROWS", 1)
    warehouse = Warehouse(spark, house.root, NIGHTS[1], NIGHTS[1].date())
    dim = increment._sent(warehouse, "dim_user")
    assert dim.runs.columns == ["_run", "_held"] and dim.runs.count() == 1
    plan = _plan(increment._fact_of(warehouse, "fact_payments", increment._silver(warehouse, "payments")))
    assert "try_element_at" in plan or "_held" in plan
    monkeypatch.setattr(increment, "SENT_MOVED", 0)
    house.night(
        users=[user(20)],
        rides=[ride("r1", 10, 1, 7, 1, 20), ride("r2", 20, 2, 7, 4), ride("r9", 10, 2, 7, 4)],
        payments=[payment("p1", "r1", 10, 1, "failed"), payment("p2", "r2", 20, 6)],
    )
    for name in ("fact_rides", "fact_payments"):
        assert house.named(name) == house.whole(name)


def test_moves_and_corrections_in_many_groups(house, monkeypatch):
    monkeypatch.setattr(increment, "GROUP_ROWS", 1)
    monkeypatch.setattr(increment, "SENT_KEYS", 0)
    stale = ("r3", 10, 2, 7, at(5), at(2), Decimal("1.00"))
    found = house.night(
        rides=[ride("r1", 10, 1, 7, 1, 20), ride("r2", 20, 2, 7, 4), stale,
               ride("r0", 30, 1, 7, 2), ride("r9", 10, 2, 7, 4)],
        payments=[payment("p1", "r1", 10, 1, "failed"), payment("p2", "r2", 20, 6)],
    )
    assert found["fact_rides"] == [20240101, 20240102, 20240103, 20240104, 20240105, None]
    for name in ("fact_rides", "fact_payments"):
        assert house.named(name) == house.whole(name)
