import datetime as dt

import pytest
from helpers import collected
from pyspark.sql import functions as F

from farebox.__main__ import main
from farebox.operators.scd2 import current_rows
from farebox.plans.nightly import TABLES, run_pipeline
from farebox.plans.star import SCHEMAS, Star
from farebox.schemas import QUALITY_LOG, REJECTED, STAGING
from farebox.sources.store import Load, Store
from farebox.testing import fixtures

SF_DIR = "/root/testdata/sf0.001"
OTHERS = {"data_quality_log": QUALITY_LOG, "stg_rides": STAGING["rides"]}
FIRST, SECOND = dt.datetime(2024, 1, 9, 2), dt.datetime(2024, 2, 1, 2)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The raw zone on two nights; the second has changed routes."""
    root = tmp_path_factory.mktemp("raw")
    for entity in fixtures.ENTITIES:
        fixtures.raw(spark, SF_DIR, entity).write.parquet(f"{root}/first/{entity}")
        if entity != "routes":
            fixtures.raw(spark, SF_DIR, entity).write.parquet(f"{root}/second/{entity}")
    routes = fixtures.raw(spark, SF_DIR, "routes")
    fixtures.changed_routes(routes).write.parquet(f"{root}/second/routes")
    return str(root)


@pytest.fixture(scope="module")
def loaded(spark, raw, tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    published = []
    results = run_pipeline(
        spark,
        f"{raw}/first",
        warehouse,
        load_ts=FIRST,
        publish=lambda name, df: published.append((name, df.columns)),
    )
    return warehouse, published, results


def contents(spark, warehouse, table):
    schema = SCHEMAS.get(table) or OTHERS[table]
    return Store(spark, str(warehouse)).read(table, schema)


def test_all_tables_are_written_and_published(spark, loaded):
    warehouse, published, (counts, log) = loaded
    assert {name: columns for name, columns in published} == {
        name: SCHEMAS[name].names for name in TABLES
    }
    assert dict(collected(counts)) == {
        "dim_user": 150,
        "dim_route": 25,
        "dim_vehicle": 10,
        "fact_rides": 1500,
    }
    stored = contents(spark, warehouse, "data_quality_log")
    assert collected(stored) == collected(log)
    assert contents(spark, warehouse, "stg_rides").count() == 1500


def test_marts_agree_with_the_facts(spark, loaded):
    warehouse, _, _ = loaded
    rides = contents(spark, warehouse, "fact_rides")
    daily = contents(spark, warehouse, "dashboard_daily")
    hourly = contents(spark, warehouse, "user_behavior_hourly")
    complete = rides.dropna(subset=["route_sk", "vehicle_sk", "date_sk"]).count()
    assert daily.agg(F.sum("total_rides")).first()[0] == complete
    cell = ["full_date", "hour_of_day", "city", "user_id", "route_number", "vehicle_type"]
    cells = hourly.groupBy(*cell).agg(F.max("total_rides").alias("n"))
    assert cells.agg(F.sum("n")).first()[0] == rides.dropna(subset=["user_sk", "route_sk"]).count()


def test_next_night_keeps_the_route_history(spark, raw, loaded, tmp_path):
    warehouse, _, _ = loaded
    for _ in range(2):
        run_pipeline(
            spark, f"{raw}/second", warehouse, load_ts=SECOND, tables=["dim_route"], stage=False
        )
        routes = contents(spark, warehouse, "dim_route")
        assert routes.count() == 25 + 5
        assert current_rows(routes).count() == 26
        assert routes.agg(F.max("route_sk")).first()[0] == 30


def test_tables_not_asked_for_are_read(spark, raw, tmp_path):
    written = []
    warehouse = str(tmp_path)
    for _ in range(2):
        written.clear()
        run_pipeline(
            spark,
            f"{raw}/first",
            warehouse,
            load_ts=dt.datetime(2024, 1, 9 + len(list(tmp_path.glob("dim_route/*"))), 2),
            tables=["fact_rides"],
            stage=False,
            publish=lambda name, df: written.append(name),
        )
    assert written == ["fact_rides"]


def test_unknown_table(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="unknown tables: fact_x"):
        run_pipeline(spark, raw, str(tmp_path), tables=["fact_x"])


def test_command_line(spark, raw, tmp_path, capsys):
    main([f"{raw}/first", str(tmp_path), "--load-ts", "2024-01-09T02:00:00", "--tables", "dim_user"])
    shown = capsys.readouterr().out
    assert "dim_user" in shown and "fact_rides" not in shown


def test_a_missing_feed_is_an_error_unless_allowed(spark, raw, tmp_path):
    for entity in fixtures.ENTITIES:
        if entity != "vehicle_positions":
            spark.read.parquet(f"{raw}/first/{entity}").write.parquet(f"{tmp_path}/raw/{entity}")
    load = dict(load_ts=FIRST, tables=["fact_vehicle_movement"], stage=False)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_pipeline(spark, f"{tmp_path}/raw", f"{tmp_path}/a", **load)
    run_pipeline(
        spark, f"{tmp_path}/raw", f"{tmp_path}/b", may_be_missing=["vehicle_positions"], **load
    )
    assert contents(spark, tmp_path / "b", "fact_vehicle_movement").count() == 0


def test_repeated_deliveries_count_once_and_are_logged(spark, raw, tmp_path):
    for entity in fixtures.ENTITIES:
        rows = spark.read.parquet(f"{raw}/first/{entity}")
        if entity == "vehicle_positions":
            rows = rows.unionByName(rows)
        rows.write.parquet(f"{tmp_path}/raw/{entity}")
    _, log = run_pipeline(
        spark, f"{tmp_path}/raw", str(tmp_path / "w"), load_ts=FIRST, stage=False,
        tables=["fact_vehicle_movement"],
    )
    once = spark.read.parquet(f"{raw}/first/vehicle_positions").count()
    moved = contents(spark, tmp_path / "w", "fact_vehicle_movement")
    assert moved.agg(F.sum("events_count")).first()[0] == once
    found = log.filter("table_name = 'raw_vehicle_positions' AND check_type = 'duplicates'")
    assert collected(found, "result_value", "status") == [(str(once), "FAIL")]


def broken(name, df):
    raise OSError("the load broke off")


def test_a_load_that_breaks_off_changes_nothing(spark, raw, tmp_path, monkeypatch):
    load = dict(load_ts=FIRST, tables=["dim_user", "dim_route", "fact_rides"])
    run_pipeline(spark, f"{raw}/first", str(tmp_path), **load)
    tables = ["dim_user", "dim_route", "fact_rides", "stg_rides", "data_quality_log"]
    before = {name: collected(contents(spark, tmp_path, name)) for name in tables}
    load["load_ts"] = SECOND
    with monkeypatch.context() as patch:
        # Between the dimensions and the facts.
        patch.setattr(Star, "_fact_rides", lambda self: broken("fact_rides", None))
        with pytest.raises(OSError):
            run_pipeline(spark, f"{raw}/second", str(tmp_path), **load)
    assert {name: collected(contents(spark, tmp_path, name)) for name in tables} == before
    left = Store(spark, str(tmp_path)).unreferenced()
    assert left and all("/version=2024020" in path for path in left)
    run_pipeline(spark, f"{raw}/second", str(tmp_path), **load)
    assert contents(spark, tmp_path, "dim_route").count() == 25 + 5
    assert contents(spark, tmp_path, "stg_rides").count() == 2 * 1500


def test_a_load_run_again_gives_its_rows_once(spark, raw, tmp_path):
    for _ in range(2):
        run_pipeline(
            spark, f"{raw}/first", str(tmp_path), load_ts=FIRST, tables=["dim_user", "dim_vehicle"]
        )
        assert contents(spark, tmp_path, "stg_rides").count() == 1500
        log = contents(spark, tmp_path, "data_quality_log")
        assert log.count() == log.dropDuplicates(["table_name", "check_type"]).count() == 6


def test_an_older_load_is_refused(spark, raw, tmp_path):
    load = dict(tables=["dim_vehicle"], stage=False)
    run_pipeline(spark, f"{raw}/first", str(tmp_path), load_ts=SECOND, **load)
    with pytest.raises(ValueError, match="which is later"):
        run_pipeline(spark, f"{raw}/first", str(tmp_path), load_ts=FIRST, **load)


def test_a_single_step_builds_what_it_needs(spark, raw, tmp_path):
    written = []
    run_pipeline(
        spark, f"{raw}/first", str(tmp_path), load_ts=FIRST, tables=["fact_payments"], stage=False,
        publish=lambda name, df: written.append(name),
    )
    assert written == ["dim_user", "fact_payments"]


def test_keys_stay_the_same(spark, raw, tmp_path):
    users = spark.read.parquet(f"{raw}/first/users")
    loads = {FIRST: "user_id % 3 <> 0", SECOND: "user_id % 2 = 0", dt.datetime(2024, 3, 1): "true"}
    given = {}
    for load_ts, chosen in loads.items():
        folder = f"{tmp_path}/{load_ts:%m}"
        users.filter(chosen).write.parquet(f"{folder}/users")
        run_pipeline(
            spark, folder, f"{tmp_path}/w", load_ts=load_ts, tables=["dim_user"], stage=False
        )
        now = dict(collected(contents(spark, f"{tmp_path}/w", "dim_user"), "user_id", "user_sk"))
        # A user who was away for a load has the key from before.
        assert all(now[user] == given[user] for user in now.keys() & given.keys())
        given |= now
    assert sorted(given.values()) == list(range(1, len(given) + 1))


def test_marts_are_tables_of_the_catalog(spark, raw, tmp_path):
    load = dict(tables=["dashboard_daily"], stage=False, database="marts")
    for load_ts, night in ((FIRST, "first"), (SECOND, "second")):
        run_pipeline(spark, f"{raw}/{night}", str(tmp_path), load_ts=load_ts, **load)
        stored = contents(spark, tmp_path, "dashboard_daily")
        assert collected(spark.table("marts.dashboard_daily")) == collected(stored)


def test_a_doubled_key_fails_the_load(spark, raw, tmp_path, monkeypatch):
    run_pipeline(
        spark, f"{raw}/first", str(tmp_path), load_ts=FIRST, tables=["dim_vehicle"], stage=False
    )
    kept = Load.read

    def doubled(load, table, schema):
        rows = kept(load, table, schema)
        return rows.unionByName(rows) if table == "dim_vehicle" else rows

    monkeypatch.setattr(Load, "read", doubled)
    with pytest.raises(RuntimeError, match="fact_rides has"):
        run_pipeline(
            spark, f"{raw}/first", str(tmp_path), load_ts=SECOND, tables=["fact_rides"], stage=False
        )


def test_quarantine_lets_the_load_go_on(spark, raw, tmp_path):
    for entity in fixtures.ENTITIES:
        rows = spark.read.parquet(f"{raw}/first/{entity}")
        if entity == "users":
            wrong = F.when(F.col("user_id") == 7, "seven").otherwise(F.col("user_id").cast("string"))
            rows = rows.withColumn("user_id", wrong)
        rows.write.parquet(f"{tmp_path}/raw/{entity}")
    load = dict(load_ts=FIRST, tables=["dim_user"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_pipeline(spark, f"{tmp_path}/raw", f"{tmp_path}/w", **load)
    for _ in range(2):
        _, log = run_pipeline(spark, f"{tmp_path}/raw", f"{tmp_path}/w", quarantine=True, **load)
        assert contents(spark, tmp_path / "w", "dim_user").count() == 149
        rejected = Store(spark, f"{tmp_path}/w").read("rejected_users", REJECTED)
        assert [row.reasons for row in rejected.collect()] == [["user_id is no int"]]
        found = log.filter("check_type = 'values do not fit' AND status = 'FAIL'")
        assert collected(found, "table_name", "result_value") == [("raw_users", "1")]
    with pytest.raises(ValueError, match="while they are staged"):
        run_pipeline(spark, raw, f"{tmp_path}/w", quarantine=True, stage=False)


def test_settings_are_applied(spark, raw, tmp_path):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    run_pipeline(
        spark, f"{raw}/first", str(tmp_path), load_ts=FIRST, tables=["dim_vehicle"], stage=False
    )
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
