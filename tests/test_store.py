import json

import pytest
from helpers import collected

from farebox.schemas import DIM_VEHICLE, FACT_PAYMENTS, _table, INT, STR
from farebox.sources.store import Store

PAIR = _table(day=INT, name=STR)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "w"))


@pytest.fixture
def pairs(rows):
    return lambda *values: rows(PAIR, *values)


def test_nothing_is_seen_before_the_commit(store, pairs):
    load = store.begin("1")
    assert load.replace("t", pairs((1, "a")), PAIR) == 1
    assert load.replace("u", pairs((1, "b"), (2, "c")), PAIR) == 2
    assert not store.has("t") and collected(store.read("t", PAIR)) == []
    assert collected(load.read("t", PAIR)) == [(1, "a")]
    load.commit()
    assert collected(store.read("t", PAIR)) == [(1, "a")]
    assert store.read("u", PAIR).count() == 2


def test_readers_keep_what_they_began_with(store, pairs):
    store_load(store, "1", pairs((1, "a")))
    seen = store.read("t", PAIR)
    store_load(store, "2", pairs((2, "b")))
    assert collected(seen) == [(1, "a")]
    assert collected(store.read("t", PAIR)) == [(2, "b")]
    assert store.state(before="2").load == "1" and store.state().number == 2


def store_load(store, name, frame):
    load = store.begin(name)
    load.replace("t", frame, PAIR)
    return load.commit()


def test_appends_are_repeatable(store, pairs):
    for name, values in (("1", [(1, "a")]), ("2", [(2, "b")]), ("2", [(2, "c")])):
        load = store.begin(name)
        load.append("log", pairs(*values), PAIR)
        load.commit()
    assert collected(store.read("log", PAIR)) == [(1, "a"), (2, "c")]
    assert collected(store.read("log", PAIR, labels=["1"])) == [(1, "a")]


def test_untouched_folders_stay(store, pairs):
    load = store.begin("1")
    every = pairs((1, "a"), (2, "b"), (3, "c"), (None, "d"))
    _, load.tables["f"] = load.write("f", every, PAIR, ["day"])
    before = load.commit().parts("f")
    load = store.begin("2")
    load.replace_folders("f", pairs((2, "x"), (4, "y")), PAIR, "day", ["day=2", "day=3", "day=4"])
    after = load.commit().parts("f")
    assert collected(store.read("f", PAIR)) == [(None, "d"), (1, "a"), (2, "x"), (4, "y")]
    assert after["day=1"] == before["day=1"] and after["day=2"] != before["day=2"]
    assert "day=3" not in after
    with pytest.raises(ValueError, match="outside"):
        store.begin("3").replace_folders("f", pairs((9, "z")), PAIR, "day", ["day=1"])


def test_a_day_is_read_without_the_others(store, pairs):
    load = store.begin("1")
    _, load.tables["f"] = load.write("f", pairs((1, "a"), (2, "b")), PAIR, ["day"])
    load.commit()
    plan = store.read("f", PAIR).filter("day = 2")
    assert len(plan.inputFiles()) == 2
    assert "PartitionFilters: [isnotnull(day" in plan._jdf.queryExecution().toString()


def test_of_two_loads_at_once_one_fails(store, pairs):
    first, second = store.begin("1"), store.begin("2")
    for load in (first, second):
        load.replace("t", pairs((1, load.name)), PAIR)
    first.commit()
    with pytest.raises(RuntimeError, match="another load"):
        second.commit()
    assert collected(store.read("t", PAIR)) == [(1, "1")]


def test_an_older_load_is_refused(store, pairs):
    store_load(store, "2", pairs((1, "a")))
    with pytest.raises(ValueError, match="later"):
        store.begin("1")


def test_a_half_written_commit_is_no_commit(store, pairs, tmp_path):
    store_load(store, "1", pairs((1, "a")))
    (tmp_path / "w" / "_commits" / ".x.draft").write_text(json.dumps({"number": 2})[:5])
    assert collected(store.read("t", PAIR)) == [(1, "a")]


def test_unreferenced_folders_are_named(store, pairs):
    one = store_load(store, "1", pairs((1, "a")))
    store.begin("2").replace("t", pairs((2, "b")), PAIR)
    store_load(store, "3", pairs((3, "c")))
    left = store.unreferenced(keep=2)
    assert len(left) == 1 and "/t/version=2-" in left[0]
    assert f"{store.root}/{one.parts('t')['whole']}" in store.unreferenced()


def test_empty_tables_keep_their_columns(store, rows):
    load = store.begin("1")
    load.replace("v", rows(DIM_VEHICLE), DIM_VEHICLE)
    _, load.tables["p"] = load.write("p", rows(FACT_PAYMENTS), FACT_PAYMENTS, ["date_sk"])
    load.commit()
    assert store.read("v", DIM_VEHICLE).schema == DIM_VEHICLE
    assert store.read("p", FACT_PAYMENTS).schema == FACT_PAYMENTS


def test_a_table_by_folders_has_no_place_in_the_catalog(store, pairs):
    load = store.begin("1")
    _, load.tables["f"] = load.write("f", pairs((1, "a")), PAIR, ["day"])
    load.commit()
    with pytest.raises(ValueError, match="written whole"):
        store.register("marts", "f")
