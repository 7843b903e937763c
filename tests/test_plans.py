"""How the operators are planned: what is shuffled, pushed down and split."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from farebox.operators.keys import lookup_sk
from farebox.operators.marts import dashboard_daily, user_behavior_rides
from farebox.operators.staging import bronze_to_silver
from farebox.plans.nightly import Warehouse
from farebox.schemas import DIM_DATE, DIM_ROUTE, DIM_USER, DIM_VEHICLE
from farebox.sources.store import Store
from farebox.testing import fixtures

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The adaptive plan after running it."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


# The queries of the package for training text have tests of their own beside it.
OWN = [name for name in sorted(entry.queries()) if not re.match(r"op\d+_|pipeline$", name)]


@pytest.mark.parametrize("name", OWN)
def test_no_nested_loops_and_no_sort_on_one_task(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # The one window over everything adds up bucket sizes.
    for line in plan.splitlines():
        if "Window [" in line and "_rows" not in line:
            assert "_bucket" in line


def test_a_hot_key_is_split(spark, without_broadcast):
    """Half of the rows look up one user, and a quarter none."""
    key = F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 2 == 0, F.col("id") % 5000)
    facts = spark.range(0, 200_000, 1, 8).select(
        F.coalesce(key, F.when(F.col("id") % 4 != 0, F.lit(17))).cast("int").alias("user_id"),
        F.concat(F.lit("ride"), F.col("id")).alias("ride_id"),
    )
    users = spark.range(5000).select(
        F.col("id").cast("int").alias("user_id"), (F.col("id") + 1).cast("int").alias("user_sk")
    )
    # With the check of the dimension's keys, and without.
    assert "skew=true" in final_plan(lookup_sk(facts, users, "user_id", "user_sk", unique=True))
    keyed = lookup_sk(facts, users, "user_id", "user_sk")
    assert "skew=true" in final_plan(keyed)
    found = keyed.agg(
        F.count(F.lit(1)), F.count("user_sk"), F.count_if(F.col("user_sk") == 18)
    ).first()
    assert tuple(found)[:2] == (200_000, 150_000) and found[2] >= 100_000


def test_cleaning_reduces_a_hot_key_before_the_shuffle(spark):
    deliveries = spark.range(0, 100_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("ride_id"),
        F.col("id").alias("end_time"),
    )
    silver = bronze_to_silver(deliveries, "ride_id", "end_time")
    execution = silver._jdf.queryExecution()
    execution.toRdd().count()
    plan = execution.executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(ride_id")
    written = _shuffled_rows(silver)
    # Every other key once, and the hot one once per task.
    assert written <= 66_668 + 4


def _shuffled_rows(df):
    """Rows the exchanges of an executed plan wrote."""
    metrics, stack = 0, [df._jdf.queryExecution().executedPlan().finalPhysicalPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "Exchange":
            metrics += node.metrics().apply("shuffleRecordsWritten").value()
        for part in (node.children(),):
            stack.extend(part.apply(i) for i in range(part.size()))
        if node.nodeName().startswith("ShuffleQueryStage"):
            stack.append(node.plan())
    return metrics


def _sent_bytes(df):
    """Bytes of the largest table that an executed plan sent to all tasks."""
    most, stack = 0, [df._jdf.queryExecution().executedPlan().finalPhysicalPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "BroadcastExchange":
            most = max(most, node.metrics().apply("dataSize").value())
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
    return most


def test_rides_do_not_send_a_row_for_each_of_many_parts(spark, tmp_path):
    """200,000 parts, at some 40 bytes each, are few bytes in a file."""
    parts = spark.range(200_000).selectExpr("id AS p_partkey", "concat('Brand#', id % 25 + 1) AS p_brand")
    orders = spark.range(300).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "1.5D AS o_totalprice",
        "timestamp_ntz'1995-01-02 00:00:00' AS o_orderdate",
    )
    lines = spark.range(299).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "id * 601 AS l_partkey", "id AS l_suppkey"
    )
    for name, rows in (("part", parts), ("orders", orders), ("lineitem", lines)):
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    rides = fixtures.rides(spark, str(tmp_path))
    final_plan(rides)
    assert 0 < _sent_bytes(rides) < 3_000_000
    found = {int(r.ride_id): r.route_id for r in rides.collect()}
    assert found == {n: n * 601 % 25 + 1 for n in range(299)} | {299: None}


def write_star(spark, folder):
    moment = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    rides = spark.range(1000).select(
        F.col("id").cast("string").alias("ride_id"),
        *[(1 + F.col("id") % n).cast("int").alias(sk) for sk, n in
          (("user_sk", 50), ("route_sk", 5), ("vehicle_sk", 20))],
        moment.alias("start_time"),
        moment.alias("end_time"),
        F.lit(60).alias("ride_duration_sec"),
        F.lit(1).cast("decimal(10,2)").alias("fare_amount"),
        F.lit(20240101).alias("date_sk"),
    )
    rides.write.parquet(f"{folder}/fact_rides")
    for name, schema in (
        ("dim_user", DIM_USER),
        ("dim_route", DIM_ROUTE),
        ("dim_vehicle", DIM_VEHICLE),
        ("dim_date", DIM_DATE),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
    names = ["fact_rides", "dim_user", "dim_route", "dim_vehicle", "dim_date"]
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def test_scans_read_only_what_is_needed(spark, tmp_path):
    star = write_star(spark, str(tmp_path))
    daily = dashboard_daily(
        star["fact_rides"], star["dim_route"], star["dim_vehicle"], star["dim_date"]
    )
    plan = plan_of(daily)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("ride_id" in s and "start_time" not in s and "user_sk" not in s for s in schemas)
    assert "vehicle_sk:int" in schemas
    assert re.search(r"PushedFilters: \[IsNotNull\(is_current\), EqualTo\(is_current,true\)", plan)


def test_dashboard_adds_up_before_it_shuffles(spark, tmp_path, without_broadcast):
    star = write_star(spark, str(tmp_path))
    plan = plan_of(
        dashboard_daily(star["fact_rides"], star["dim_route"], star["dim_vehicle"], star["dim_date"])
    )
    above_scan = plan.splitlines()
    above_scan = above_scan[: next(i for i, x in enumerate(above_scan) if "FileScan" in x)]
    assert "ride_id" in plan.splitlines()[len(above_scan)]
    exchange = max(i for i, line in enumerate(above_scan) if "Exchange" in line)
    partial = max(i for i, line in enumerate(above_scan) if "partial_count(ride_id" in line)
    assert partial > exchange


def test_hourly_mart_shuffles_rides_once_when_users_are_broadcast(spark, tmp_path):
    star = write_star(spark, str(tmp_path))
    rides = user_behavior_rides(
        star["fact_rides"], star["dim_user"], star["dim_route"], star["dim_date"]
    )
    assert len(re.findall(r"\bExchange hashpartitioning", plan_of(rides))) == 1


def test_history_and_snapshot_are_joined_once(spark):
    """The merged versions are stored; all that is left to join are the offsets of key buckets."""
    plan = final_plan(entry.queries()["dim_route_scd2"](spark, SF_DIR))
    assert "FullOuter" not in plan and "SortMergeJoin" not in plan
    assert "SortAggregate" not in plan
    assert "Scan ExistingRDD" in plan and "lag(" not in plan and "lead(" not in plan


def test_a_vouched_lookup_reads_the_dimension_once(spark):
    users = spark.range(5000).selectExpr("CAST(id AS INT) AS user_id", "CAST(id + 1 AS INT) AS user_sk")
    facts = spark.range(10).selectExpr("CAST(id AS INT) AS user_id")
    checked = plan_of(lookup_sk(facts, users, "user_id", "user_sk"))
    vouched = plan_of(lookup_sk(facts, users, "user_id", "user_sk", unique=True))
    assert "Aggregate" in checked and "Aggregate" not in vouched and "Subquery" not in vouched


def test_closed_versions_are_not_scanned(spark, tmp_path):
    """A merge of routes reads the open versions alone."""
    root = str(tmp_path)
    routes = spark.createDataFrame(
        [(1, "A", "bus", 40), (2, "B", "tram", 45)],
        "route_id int, route_number string, vehicle_type string, base_fare int",
    )
    for day in (1, 2, 3):
        moment = dt.datetime(2024, 1, day)
        house = Warehouse(spark, root, moment, moment.date())
        read = []
        kept = house.store.read_parts
        house.store.read_parts = lambda schema, parts: read.append(parts) or kept(schema, parts)
        raised = F.col("base_fare") + day * (F.col("route_id") == 1).cast("int")
        snapshot = routes.withColumn("base_fare", raised)
        versions = house.route_versions(snapshot)
        assert all("is_current=true" in part for parts in read for part in parts)
        house.keep_routes(versions)
        house.load.commit()
    stored = Store(spark, root).read("dim_route", DIM_ROUTE)
    assert stored.count() == 4 and stored.filter("is_current").count() == 2
    assert len(Store(spark, root).state().parts("dim_route")) == 3
