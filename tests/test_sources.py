import datetime as dt
from decimal import Decimal

import pytest
from helpers import collected
from pyspark.sql import functions as F

from farebox.schemas import DIM_VEHICLE, FACT_PAYMENTS, FACT_RIDES, USER_BEHAVIOR_HOURLY
from farebox.session import shared_folder
from farebox.sources.jdbc import JdbcTarget, Slices, read_options, write_jdbc, write_options
from farebox.sources.raw import read_or_empty, read_raw
from farebox.sources.tables import write_bucketed_table, write_mart, write_table

DATABASE = JdbcTarget("jdbc:some:db", {"user": "u", "password": "p"})


def test_read_raw(spark, rows, tmp_path):
    write_table(rows(DIM_VEHICLE, (1, 2, "X", 3)), f"{tmp_path}/dim_vehicle", DIM_VEHICLE)
    assert collected(read_raw(spark, f"{tmp_path}/", "dim_vehicle")) == [(1, 2, "X", 3)]
    with pytest.raises(ValueError, match="Unsupported format: csv"):
        read_raw(spark, str(tmp_path), "dim_vehicle", "csv")


def test_read_or_empty(spark, tmp_path):
    path = f"{tmp_path}/dim_vehicle"
    absent = read_or_empty(spark, path, DIM_VEHICLE)
    assert absent.schema == DIM_VEHICLE and absent.count() == 0
    write_table(spark.createDataFrame([(1, 2, "X", 3)], DIM_VEHICLE), path, DIM_VEHICLE)
    assert read_or_empty(spark, path, DIM_VEHICLE).count() == 1


def test_unreadable_is_not_absent(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="not a Parquet file"):
        read_or_empty(spark, f"{tmp_path}/broken", DIM_VEHICLE).count()


def test_write_table_counts_and_appends(spark, rows, tmp_path):
    path, table = f"{tmp_path}/t", rows(DIM_VEHICLE, (1, 2, "X", 3), (2, 3, "Y", 4))
    assert write_table(table, path, DIM_VEHICLE) == 2
    assert write_table(table.limit(1), path, DIM_VEHICLE, mode="append") == 1
    assert spark.read.parquet(path).count() == 3
    assert write_table(table.limit(0), path, DIM_VEHICLE) == 0
    assert spark.read.parquet(path).schema.simpleString() == DIM_VEHICLE.simpleString()


def test_shared_folder_is_the_one_named(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark))


def test_jdbc_read_options():
    plain = read_options(DATABASE, "dim_user")
    assert plain["url"] == "jdbc:some:db" and plain["dbtable"] == "dim_user"
    assert plain["user"] == "u" and "numPartitions" not in plain
    sliced = read_options(DATABASE, "fact_rides", Slices("date_sk", 20240101, 20241231, 32))
    assert sliced["partitionColumn"] == "date_sk" and sliced["numPartitions"] == "32"
    assert sliced["lowerBound"] == "20240101" and sliced["upperBound"] == "20241231"


def test_jdbc_write_options_keep_the_table_definition():
    options = write_options(DATABASE, "dim_user", connections=4)
    assert options["truncate"] == "true" and options["numPartitions"] == "4"


def test_unknown_jdbc_target(rows):
    with pytest.raises(ValueError, match="Unknown target: olap"):
        write_jdbc(rows("x int"), {"dwh": DATABASE}, "olap", "t")


def mart_rows(spark, count):
    """Hours over two months; one day of them holds half of the rows."""
    day = F.when(F.col("id") % 2 == 0, F.lit(dt.date(2024, 1, 15))).otherwise(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 60).cast("int"))
    )
    hours = spark.range(count).select(
        day.alias("full_date"),
        (F.col("id") % 24).alias("hour_of_day"),
        F.lit(1).alias("day_of_week"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("city"),
        F.col("id").alias("user_id"),
        F.lit("A").alias("route_number"),
        F.lit("bus").alias("vehicle_type"),
        F.lit("card").alias("payment_method"),
        *[F.lit(1).alias(name) for name in USER_BEHAVIOR_HOURLY.names[8:]],
    )
    return hours


def test_mart_is_split_by_month_and_sorted(spark, tmp_path):
    path = f"{tmp_path}/mart"
    assert write_mart(mart_rows(spark, 3000), path) == 3000
    stored = spark.read.parquet(path)
    assert stored.schema.names == [*USER_BEHAVIOR_HOURLY.names, "yyyymm"]
    assert collected(stored.groupBy("yyyymm").agg(F.min("full_date"))) == [
        (202401, dt.date(2024, 1, 2)),
        (202402, dt.date(2024, 2, 1)),
    ]
    file_of = F.input_file_name().alias("file")
    for key in stored.select(file_of).distinct().collect():
        order = [
            tuple(r)
            for r in stored.filter(F.input_file_name() == key["file"])
            .select("full_date", "hour_of_day", "city")
            .collect()
        ]
        assert order == sorted(order)
    plan = stored.filter("yyyymm = 202402")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan


def test_a_heavy_day_is_split_over_files(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
    path = f"{tmp_path}/mart"
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        write_mart(mart_rows(spark, 60_000), path)
    finally:
        for name in settings:
            spark.conf.unset(name)
    heavy = spark.read.parquet(path).filter(F.col("full_date") == dt.date(2024, 1, 15))
    files = heavy.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 30_000
    assert len(files) > 1


def test_bucketed_facts_join_without_a_shuffle(spark, rows, tmp_path):
    moment = dt.datetime(2024, 1, 1)
    rides = rows(FACT_RIDES, ("r", 1, 1, 1, moment, moment, 0, Decimal("1.00"), 20240101))
    payments = rows(
        FACT_PAYMENTS, ("p", "r", 1, Decimal("1.00"), "card", "success", moment, 20240101)
    )
    write_bucketed_table(rides, "b_rides", f"{tmp_path}/r", FACT_RIDES, "ride_id", 4)
    write_bucketed_table(payments, "b_payments", f"{tmp_path}/p", FACT_PAYMENTS, "ride_id", 4)
    try:
        joined = spark.table("b_payments").join(
            spark.table("b_rides").hint("merge").select("ride_id", "route_sk"), "ride_id"
        )
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert collected(joined, "payment_id", "route_sk") == [("p", 1)]
    finally:
        spark.sql("DROP TABLE b_rides")
        spark.sql("DROP TABLE b_payments")


def test_a_cluster_needs_a_shared_folder():
    class Session:
        """A session's settings, and nothing behind them."""

        def __init__(self, master, **settings):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = settings

    local = {"spark.sql.warehouse.dir": "file:/tmp/spark-warehouse"}
    remote = {"spark.sql.warehouse.dir": "hdfs://host/warehouse/"}
    named = {**local, "spark.checkpoint.dir": "/mnt/shared"}
    assert shared_folder(Session("local[8]", **local)) == "file:/tmp/spark-warehouse/_intermediate"
    assert shared_folder(Session("yarn", **remote)) == "hdfs://host/warehouse/_intermediate"
    assert shared_folder(Session("spark://host:7077", **named)) == "/mnt/shared"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="all executors reach"):
            shared_folder(Session(master, **local))
