import datetime as dt
from decimal import Decimal

import pytest
from helpers import collected

from farebox.functions.dates import OPEN_END
from farebox.operators.scd2 import current_rows, merge_route_snapshots, merge_routes
from farebox.schemas import DIM_ROUTE, RAW

JAN, FEB, MAR = (dt.date(2024, month, 1) for month in (1, 2, 3))


def fare(text):
    return Decimal(text)


def version(sk, route, number, kind, price, start, end=OPEN_END):
    return (sk, route, number, kind, fare(price), start, end, end == OPEN_END)


@pytest.fixture
def snapshot(rows):
    return lambda *routes: rows(RAW["routes"], *[(r, n, k, fare(p)) for r, n, k, p in routes])


@pytest.fixture
def empty(rows):
    return rows(DIM_ROUTE)


@pytest.fixture
def loaded(rows):
    return rows(
        DIM_ROUTE,
        version(1, 10, "A", "bus", "40.00", JAN),
        version(2, 20, "B", "tram", "45.00", JAN),
        version(3, 30, "C", None, "50.00", JAN),
    )


def test_first_load(empty, snapshot):
    routes = snapshot((20, "B", "tram", "45.00"), (10, "A", "bus", "40.00"))
    merged = merge_routes(empty, routes, JAN)
    assert merged.schema.simpleString() == DIM_ROUTE.simpleString()
    assert collected(merged) == [
        version(1, 10, "A", "bus", "40.00", JAN),
        version(2, 20, "B", "tram", "45.00", JAN),
    ]


def test_new_changed_unchanged_and_missing(loaded, snapshot):
    routes = snapshot(
        (40, "D", "metro", "60.00"), (10, "A", "bus", "41.00"), (20, "B", "tram", "45.00")
    )
    assert collected(merge_routes(loaded, routes, FEB)) == [
        version(1, 10, "A", "bus", "40.00", JAN, dt.date(2024, 1, 31)),
        version(2, 20, "B", "tram", "45.00", JAN),
        version(3, 30, "C", None, "50.00", JAN),
        version(4, 10, "A", "bus", "41.00", FEB),
        version(5, 40, "D", "metro", "60.00", FEB),
    ]


def test_null_is_a_value(loaded, snapshot):
    gained = merge_routes(loaded, snapshot((30, "C", "bus", "50.00")), FEB)
    assert collected(current_rows(gained).filter("route_id = 30")) == [
        version(4, 30, "C", "bus", "50.00", FEB)
    ]
    same = merge_routes(loaded, snapshot((30, "C", None, "50.00")), FEB)
    assert collected(same) == collected(loaded)
    lost = merge_routes(loaded, snapshot((10, None, "bus", "40.00")), FEB)
    assert collected(current_rows(lost), "route_sk", "route_number")[0] == (2, "B")
    assert (4, None) in collected(current_rows(lost), "route_sk", "route_number")


def test_second_change_on_one_day_amends(loaded, snapshot):
    once = merge_routes(loaded, snapshot((10, "A", "bus", "41.00")), FEB)
    twice = merge_routes(once, snapshot((10, "A", "bus", "42.00")), FEB)
    assert collected(twice.filter("route_id = 10")) == [
        version(1, 10, "A", "bus", "40.00", JAN, dt.date(2024, 1, 31)),
        version(4, 10, "A", "bus", "42.00", FEB),
    ]


def test_rerun_changes_nothing(loaded, snapshot):
    routes = snapshot((10, "A", "bus", "41.00"), (50, "E", "bus", "10.00"))
    once = merge_routes(loaded, routes, FEB)
    assert collected(merge_routes(once, routes, FEB)) == collected(once)
    assert collected(merge_routes(once, routes, MAR)) == collected(once)


def test_versions_follow_one_another(loaded, snapshot):
    merged = loaded
    for day, price in ((FEB, "41.00"), (MAR, "42.00")):
        merged = merge_routes(merged, snapshot((10, "A", "bus", price)), day)
    spans = collected(merged.filter("route_id = 10"), "valid_from", "valid_to", "is_current")
    assert spans == [
        (JAN, dt.date(2024, 1, 31), False),
        (FEB, dt.date(2024, 2, 29), False),
        (MAR, OPEN_END, True),
    ]
    assert all(n == 1 for _, n in collected(current_rows(merged).groupBy("route_id").count()))


def test_as_of_defaults_to_today(empty, snapshot):
    merged = merge_routes(empty, snapshot((1, "A", "bus", "1.00")))
    assert abs(merged.first()["valid_from"] - dt.datetime.now(dt.UTC).date()) <= dt.timedelta(days=1)


@pytest.mark.parametrize(
    ("routes", "day", "message"),
    [
        ([(10, "A", "bus", "1.00"), (10, "A", "bus", "1.00")], FEB, "repeats a business key"),
        ([(None, "A", "bus", "1.00")], FEB, "null business key"),
        ([(10, "A", "bus", "1.00")], dt.date(2023, 1, 1), "older than a current version"),
    ],
)
def test_bad_snapshots_fail(loaded, snapshot, routes, day, message):
    # Which exception arrives depends on how many tasks fail at once.
    with pytest.raises(Exception, match=message):
        merge_routes(loaded, snapshot(*routes), day).collect()


def test_two_current_versions_of_a_key_are_refused(rows, snapshot):
    doubled = rows(
        DIM_ROUTE,
        version(1, 10, "A", "bus", "40.00", JAN),
        version(2, 10, "A", "bus", "42.00", JAN),
    )
    with pytest.raises(Exception, match="two current versions"):
        merge_routes(doubled, snapshot((10, "A", "bus", "41.00")), FEB).collect()


SNAPSHOTS = {
    FEB: [(10, "A", "bus", "41.00"), (20, "B", "tram", "45.00"), (40, "D", "bus", "9.00")],
    MAR: [(10, "A", "bus", "40.00"), (30, "C", "bus", "50.00"), (40, "D", "bus", "9.00")],
    dt.date(2024, 4, 1): [(10, "A", "bus", "40.00"), (5, "E", None, "1.00"), (20, None, "tram", "45.00")],
}


def test_snapshots_at_once_equal_one_after_another(loaded, snapshot):
    merged = loaded
    for day, routes in SNAPSHOTS.items():
        merged = merge_routes(merged, snapshot(*routes), day)
    # In any order of delivery.
    frames = {day: snapshot(*SNAPSHOTS[day]) for day in reversed(SNAPSHOTS)}
    once = merge_route_snapshots(loaded, frames, after=3)
    assert collected(once) == collected(merged)


def test_snapshots_on_the_day_of_a_version_amend_it(loaded, snapshot):
    frames = {JAN: snapshot((10, "A", "bus", "42.00")), FEB: snapshot((10, "A", "bus", "42.00"))}
    assert collected(merge_route_snapshots(loaded, frames, after=3).filter("route_id = 10")) == [
        version(1, 10, "A", "bus", "42.00", JAN)
    ]


def test_bad_snapshots_among_several_fail(loaded, snapshot):
    good = snapshot((10, "A", "bus", "41.00"))
    twice = snapshot((20, "B", "bus", "1.00"), (20, "B", "bus", "2.00"))
    for frames, message in (
        ({FEB: good, MAR: twice}, "repeats a business key"),
        ({dt.date(2023, 5, 1): good, MAR: good}, "older than a current version"),
    ):
        with pytest.raises(Exception, match=message):
            merge_route_snapshots(loaded, frames, after=3).collect()
