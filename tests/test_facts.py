import datetime as dt
from decimal import Decimal

import pytest
from helpers import collected

from farebox.functions.dates import OPEN_END
from farebox.operators.dimensions import build_dim_date, build_dim_user, build_dim_vehicle
from farebox.operators.facts import (
    build_fact_payments,
    build_fact_rides,
    build_fact_vehicle_movement,
)
from farebox.schemas import (
    DIM_DATE,
    DIM_ROUTE,
    DIM_USER,
    DIM_VEHICLE,
    FACT_PAYMENTS,
    FACT_RIDES,
    FACT_VEHICLE_MOVEMENT,
    RAW,
)

START, END = dt.datetime(2024, 1, 1, 23, 50), dt.datetime(2024, 1, 2, 0, 10, 5)
DAY = dt.date(2024, 1, 1)
FARE = Decimal("45.00")


@pytest.fixture
def dim_user(rows):
    return rows(DIM_USER, (1, 7, "n", "e", "Town", START), (2, 8, "n", "e", None, START))


@pytest.fixture
def dim_route(rows):
    closed = (1, 70, "A", "bus", FARE, DAY, DAY, False)
    return rows(
        DIM_ROUTE,
        closed,
        (2, 70, "A", "bus", FARE, DAY, OPEN_END, True),
        (3, 80, "B", "tram", FARE, DAY, OPEN_END, True),
        (4, 90, "B", "metro", FARE, DAY, OPEN_END, True),
    )


@pytest.fixture
def dim_vehicle(rows):
    return rows(DIM_VEHICLE, (5, 100, "P", 50))


def test_dimensions(rows):
    users = rows(RAW["users"], (9, "n", "e", "c", START), (7, "m", "f", "d", END))
    built = build_dim_user(users)
    assert built.schema.simpleString() == DIM_USER.simpleString()
    assert collected(built, "user_sk", "user_id", "name") == [(1, 7, "m"), (2, 9, "n")]
    vehicles = rows(RAW["vehicles"], (3, 1, "X", 60), (2, 1, "Y", 70))
    assert collected(build_dim_vehicle(vehicles)) == [(1, 2, "Y", 70), (2, 3, "X", 60)]


def test_duplicate_users_stay(rows):
    users = rows(RAW["users"], (7, "m", "f", "d", END), (7, "m", "f", "d", END))
    assert collected(build_dim_user(users), "user_sk", "user_id") == [(1, 7), (2, 7)]


def test_calendar_spans_all_moments(rows):
    starts = rows("t timestamp_ntz", (dt.datetime(2024, 2, 28, 23),), (None,))
    paid = rows("t timestamp_ntz", (dt.datetime(2024, 3, 2, 1),), (dt.datetime(2024, 2, 29, 1),))
    calendar = build_dim_date(starts, paid)
    assert calendar.schema.simpleString() == DIM_DATE.simpleString()
    assert collected(calendar) == [
        (20240228, dt.date(2024, 2, 28), 2024, 2, 28, 4),
        (20240229, dt.date(2024, 2, 29), 2024, 2, 29, 5),
        (20240301, dt.date(2024, 3, 1), 2024, 3, 1, 6),
        (20240302, dt.date(2024, 3, 2), 2024, 3, 2, 7),
    ]
    assert build_dim_date(starts.filter("t is null")).count() == 0


def test_rides_get_current_keys(rows, dim_user, dim_route, dim_vehicle):
    rides = rows(
        RAW["rides"],
        ("r1", 7, 70, 100, START, END, FARE),
        ("r2", 99, 99, 99, START, None, FARE),
        ("r3", None, None, None, START, END, None),
    )
    fact = build_fact_rides(rides, dim_user, dim_route, dim_vehicle)
    assert fact.schema.simpleString() == FACT_RIDES.simpleString()
    assert collected(fact) == [
        ("r1", 1, 2, 5, START, END, 1205, FARE, 20240101),
        ("r2", None, None, None, START, None, None, FARE, 20240101),
        ("r3", None, None, None, START, END, 1205, None, 20240101),
    ]


def test_payments(rows, dim_user):
    payments = rows(
        RAW["payments"],
        ("p1", "r1", 7, FARE, "card", "success", END),
        ("p2", "r2", 99, FARE, None, None, END),
    )
    fact = build_fact_payments(payments, dim_user)
    assert fact.schema.simpleString() == FACT_PAYMENTS.simpleString()
    assert collected(fact) == [
        ("p1", "r1", 1, FARE, "card", "success", END, 20240102),
        ("p2", "r2", None, FARE, None, None, END, 20240102),
    ]


def test_vehicle_movement(rows, dim_route):
    def position(number, moment, speed, passengers):
        return ("e", 1, number, moment, None, None, speed and Decimal(speed), passengers)

    positions = rows(
        RAW["vehicle_positions"],
        position("A", START, "10.00", 3),
        position("A", START, "10.01", 4),
        position("A", START, None, None),
        position("A", END, None, None),
        position("B", START, "20.00", 9),
        position("X", START, "30.00", 1),
        position("Y", START, "31.00", 2),
        position(None, START, "32.00", 9),
    )
    # A number that two current routes share is refused, not counted twice.
    with pytest.raises(Exception, match="route_number occurs in several rows"):
        build_fact_vehicle_movement(positions, dim_route).collect()
    movement = build_fact_vehicle_movement(positions, dim_route.filter("route_sk != 4"))
    assert movement.schema.simpleString() == FACT_VEHICLE_MOVEMENT.simpleString()
    assert collected(movement) == [
        # Unknown routes share the null key of a day.
        (None, 20240101, Decimal("31.00"), 4, 3),
        # 10.005 is rounded half up, 3.5 passengers are cut off.
        (2, 20240101, Decimal("10.01"), 3, 3),
        (2, 20240102, None, None, 1),
        (3, 20240101, Decimal("20.00"), 9, 1),
    ]
