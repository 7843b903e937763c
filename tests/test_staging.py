import datetime as dt
from decimal import Decimal

import pytest
from helpers import collected
from pyspark.errors import PySparkException

from farebox.operators.staging import bronze_to_silver, check_types, clean, load_staging
from farebox.schemas import RAW, STAGING, conform

NOON = dt.datetime(2024, 1, 1, 12)


def test_conform_casts_orders_and_drops_columns(rows):
    raw = rows(
        "base_fare double, route_number string, extra int, vehicle_type string, route_id long",
        (45.125, "A-1", 7, "bus", 3),
    )
    routes = conform(raw, RAW["routes"])
    assert routes.schema.simpleString() == RAW["routes"].simpleString()
    assert collected(routes) == [(3, "A-1", "bus", Decimal("45.13"))]


def test_conform_names_missing_columns(rows):
    with pytest.raises(ValueError, match="missing columns: vehicle_type, base_fare"):
        conform(rows("route_id int, route_number string", (1, "A")), RAW["routes"])


def test_value_that_does_not_fit_fails(rows):
    raw = rows(
        "route_id long, route_number string, vehicle_type string, base_fare double",
        (2**40, "A", "bus", 1.0),
    )
    with pytest.raises(PySparkException):
        conform(raw, RAW["routes"]).collect()


def test_staging_stamps_the_load(rows):
    raw = rows("vehicle_id long, route_id long, license_plate string, capacity long", (1, 2, "X", 3))
    staged = load_staging(raw, "vehicles", NOON)
    assert staged.schema.simpleString() == STAGING["vehicles"].simpleString()
    assert collected(staged) == [(1, 2, "X", 3, NOON)]
    by_clock = load_staging(raw, "vehicles").first()["load_ts"]
    assert abs(by_clock - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_latest_delivery_wins_and_null_keys_go(rows):
    hour = dt.timedelta(hours=1)
    raw = rows(
        RAW["users"],
        (1, "a", "a@x", "Old", NOON),
        (1, "a", "a@x", "New", NOON + hour),
        (2, "b", "b@x", None, None),
        (2, "b", "b@x", None, NOON),
        (None, "c", "c@x", "X", NOON),
        (3, "d", "d@x", "Z", NOON),
        (3, "e", "d@x", "A", NOON),
    )
    expected = [
        (1, "a", "a@x", "New", NOON + hour),
        (2, "b", "b@x", None, NOON),
        (3, "e", "d@x", "A", NOON),
    ]
    assert collected(clean(raw, "users")) == expected
    assert collected(clean(raw.repartition(7), "users")) == expected


def test_without_event_time_the_other_columns_decide(rows):
    raw = rows(RAW["vehicles"], (1, 1, "A", 50), (1, 1, "B", 40), (1, 1, "B", 40))
    assert collected(bronze_to_silver(raw, "vehicle_id")) == [(1, 1, "B", 40)]


def test_values_that_do_not_fit_are_set_aside(spark, rows):
    text = "user_id string, name string, email string, city string, created_at string"
    faulty = rows(
        text,
        ("1", "a", "e", "X", "2024-01-01 00:00:00"),
        ("x", "b", None, "Y", "2024-01-02 00:00:00"),
        ("99999999999", "c", "e", "Z", "soon"),
        (None, "d", "e", "X", None),
    )
    found = check_types(faulty, "users", dt.datetime(2024, 1, 9))
    kept = found.filter("accepted")
    assert collected(kept, "user_id", "name") == [(None, "d"), (1, "a")]
    assert kept.filter("delivered IS NOT NULL OR size(reasons) > 0").count() == 0
    assert collected(found.filter("not accepted"), "name", "reasons", "delivered") == [
        (
            "b", ["user_id is no int"],
            '{"user_id":"x","name":"b","email":null,"city":"Y","created_at":"2024-01-02 00:00:00"}',
        ),
        (
            "c", ["user_id is no int", "created_at is no timestamp_ntz"],
            '{"user_id":"99999999999","name":"c","email":"e","city":"Z","created_at":"soon"}',
        ),
    ]
    with pytest.raises(ValueError, match="missing columns: city"):
        check_types(faulty.drop("city"), "users")
