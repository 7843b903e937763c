import datetime as dt
from decimal import Decimal

import pytest
from helpers import collected
from pyspark.sql import functions as F

from farebox.functions.dates import OPEN_END
from farebox.operators.marts import dashboard_daily, user_behavior_hourly, user_behavior_payments
from farebox.schemas import (
    DASHBOARD_DAILY,
    DIM_DATE,
    DIM_ROUTE,
    DIM_USER,
    DIM_VEHICLE,
    FACT_PAYMENTS,
    FACT_RIDES,
    USER_BEHAVIOR_HOURLY,
)

DAY = dt.date(2024, 1, 1)
MONDAY = (DAY, 10, 2)


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def money(text):
    return Decimal(text)


def ride(name, user, route, start, seconds, price, vehicle=5):
    end = start + dt.timedelta(seconds=seconds)
    return (name, user, route, vehicle, start, end, seconds, money(price), 20240101)


def payment(name, of, user, moment, method="card", status="success"):
    return (name, of, user, money("1.00"), method, status, moment, 20240101)


@pytest.fixture
def star(rows):
    """Dimensions, and a function adding facts to them."""
    dim_user = rows(
        DIM_USER,
        (1, 7, "n", "e", "Town", at(0)),
        (2, 8, "n", "e", None, at(0)),
        # The first user, delivered twice.
        (3, 7, "n", "e", "Town", at(0)),
    )
    dim_route = rows(
        DIM_ROUTE,
        (1, 70, "A", "bus", money("1.00"), DAY, OPEN_END, True),
        (2, 80, "B", "tram", money("1.00"), DAY, DAY, False),
        (3, 80, "B", "metro", money("1.00"), DAY, OPEN_END, True),
    )
    dim_vehicle = rows(DIM_VEHICLE, (5, 100, "P", 50))
    dim_date = rows(DIM_DATE, (20240101, DAY, 2024, 1, 1, 2))

    def mart(name, rides=(), payments=()):
        fact_rides, fact_payments = rows(FACT_RIDES, *rides), rows(FACT_PAYMENTS, *payments)
        return {
            "hourly": lambda: user_behavior_hourly(
                fact_rides, fact_payments, dim_user, dim_route, dim_date
            ),
            "payments": lambda: user_behavior_payments(
                fact_payments, fact_rides, dim_user, dim_route, dim_date
            ),
            "daily": lambda: dashboard_daily(fact_rides, dim_route, dim_vehicle, dim_date),
        }[name]()

    return mart


def test_rides_repeat_per_payment_method(star):
    mart = star(
        "hourly",
        [ride("r1", 1, 1, at(10), 90, "10.00"), ride("r2", 3, 1, at(10), 91, "10.01")],
        [
            payment("p1", "r1", 1, at(10, 5)),
            payment("p2", "r2", 1, at(10, 6), "wallet", "failed"),
            payment("p3", "r2", 3, at(10, 6), "wallet", "success"),
        ],
    )
    assert mart.schema.simpleString() == USER_BEHAVIOR_HOURLY.simpleString()
    cell = (*MONDAY, "Town", 7, "A", "bus")
    measures = (2, money("20.01"), 90, money("10.01"))
    assert collected(mart) == [
        (*cell, "card", *measures, 1, 1),
        (*cell, "wallet", *measures, 2, 1),
    ]


def test_ride_across_the_hour_gives_two_rows(star):
    mart = star(
        "hourly", [ride("r", 1, 1, at(10, 50), 1200, "9.00")], [payment("p", "r", 1, at(11, 10))]
    )
    cell = ("Town", 7, "A", "bus")
    assert collected(mart) == [
        (DAY, 10, 2, *cell, None, 1, money("9.00"), 1200, money("9.00"), 0, 0),
        (DAY, 11, 2, *cell, "card", 0, money("0.00"), 0, money("0.00"), 1, 1),
    ]


def test_unknown_city_never_meets(star):
    mart = star(
        "hourly", [ride("r", 2, 1, at(10), 60, "9.00")], [payment("p", "r", 2, at(10, 1))]
    )
    assert collected(mart, "city", "user_id", "payment_method", "total_rides", "total_payments") == [
        (None, 8, None, 1, 0),
        (None, 8, "card", 0, 1),
    ]


def test_rows_without_keys_drop_out(star):
    mart = star(
        "hourly",
        [
            ride("user", None, 1, at(10), 60, "9.00"),
            ride("route", 1, None, at(10), 60, "9.00"),
            ride("closed", 1, 2, at(10), 60, "9.00"),
            (*ride("day", 1, 1, at(10), 60, "9.00")[:-1], 20300101),
        ],
        [
            payment("p1", "route", 1, at(10)),
            payment("p2", "nowhere", 1, at(10)),
            payment("p3", None, 1, at(10)),
            payment("p4", "closed", None, at(10)),
        ],
    )
    assert collected(mart) == []


def test_payment_counts_once_on_the_route_of_its_ride(star):
    mart = star(
        "payments",
        [ride("r1", 1, 3, at(9), 60, "9.00"), ride("r2", 1, 1, at(9), 60, "9.00")],
        [payment("p", "r1", 1, at(10), None, None)],
    )
    assert collected(mart) == [(*MONDAY, "Town", 7, "B", "metro", None, 1, 0)]


def test_missing_values_in_measures(star):
    no_fare = (*ride("r", 1, 1, at(10), 60, "1.00")[:5], None, None, None, 20240101)
    assert collected(star("hourly", [no_fare]))[0][8:] == (1, money("0.00"), 0, money("0.00"), 0, 0)
    assert collected(star("daily", [no_fare])) == [(DAY, "A", "bus", 1, None, None, None)]


def test_dashboard(star):
    mart = star(
        "daily",
        [
            ride("r1", 1, 1, at(9), 60, "10.00"),
            ride("r2", None, 1, at(10), 61, "10.01"),
            ride("r3", 1, 3, at(10), 100, "99999999.99"),
            ride("r4", 1, 3, at(10), 100, "99999999.99"),
            ride("no vehicle", 1, 1, at(9), 60, "10.00", vehicle=None),
            ride("unknown vehicle", 1, 1, at(9), 60, "10.00", vehicle=6),
            ride("closed route", 1, 2, at(9), 60, "10.00"),
        ],
    )
    assert mart.schema.simpleString() == DASHBOARD_DAILY.simpleString()
    assert collected(mart) == [
        (DAY, "A", "bus", 2, money("20.01"), money("60.50"), money("10.01")),
        (DAY, "B", "metro", 2, money("199999999.98"), money("100.00"), money("99999999.99")),
    ]


def test_hot_cells_equal_a_plain_count(spark, star):
    """Two thirds of the rides share one user, route and hour."""
    rides = [
        ride(str(i), 1 if i % 3 else 3, 1 if i % 3 else 3, at(10 if i % 3 else i % 24), i % 7, "1.00")
        for i in range(900)
    ]
    mart = star("hourly", rides, [payment(f"p{r[0]}", r[0], r[1], r[4]) for r in rides])
    totals = mart.agg(F.sum("total_rides"), F.sum("total_payments")).first()
    assert tuple(totals) == (900, 900)
    assert mart.agg(F.max("total_rides")).first()[0] == 600
