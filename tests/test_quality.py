import datetime as dt

from helpers import collected
from pyspark.sql import functions as F

from farebox.functions.dates import date_sk
from farebox.operators.quality import (
    duplicate_checks,
    failed_checks,
    freshness,
    freshness_of_days,
    null_checks,
    quality_log,
    row_counts,
)
from farebox.schemas import QUALITY_LOG
from farebox.sources.raw import footer_scan

NOW = dt.datetime(2024, 1, 2)
LATEST = dt.datetime(2024, 1, 1, 23, 59, 30)


def test_row_counts(rows):
    tables = {"a": rows("x int", (1,), (None,)), "b": rows("x int")}
    assert collected(row_counts(tables)) == [("a", 2), ("b", 0)]


def test_null_checks(rows):
    table = rows("x int, y int", (1, None), (None, None))
    checks = null_checks({"t": (table, ["x", "y"]), "e": (rows("z int"), ["z"])})
    assert collected(checks) == [
        ("e", 0, "z is null"),
        ("t", 1, "x is null"),
        ("t", 2, "y is null"),
    ]


def test_freshness(rows):
    moments = rows("t timestamp_ntz", (LATEST,), (dt.datetime(2023, 1, 1),), (None,))
    empty = rows("t timestamp_ntz")
    assert collected(freshness({"m": (moments, "t"), "e": (empty, "t")}, NOW)) == [
        ("e", None, None),
        ("m", LATEST, 30),
    ]


def test_null_keys_count_as_duplicates(rows):
    table = rows("k int", (1,), (1,), (1,), (2,), (None,), (None,))
    assert collected(duplicate_checks({"t": (table, "k")})) == [("t", 4)]


def test_log_and_failures(rows):
    log = quality_log(
        null_checks({"t": (rows("x int", (1,)), ["x"])}),
        freshness(
            {
                "fresh": (rows("t timestamp_ntz", (LATEST,)), "t"),
                "stale": (rows("t timestamp_ntz", (dt.datetime(2023, 1, 1),)), "t"),
                "empty": (rows("t timestamp_ntz"), "t"),
            },
            NOW,
        ),
        duplicate_checks({"t": (rows("x int", (1,), (1,)), "x")}),
        max_lag_seconds=30,
        check_date=NOW,
    )
    assert log.schema.simpleString() == QUALITY_LOG.simpleString()
    failed = [
        (NOW, "empty", "freshness", None, "FAIL"),
        (NOW, "stale", "freshness", str(366 * 86400), "FAIL"),
        (NOW, "t", "duplicates", "1", "FAIL"),
    ]
    passed = [
        (NOW, "fresh", "freshness", "30", "PASS"),
        (NOW, "t", "x is null", "0", "PASS"),
    ]
    assert collected(failed_checks(log)) == failed
    assert collected(log) == sorted(failed + passed, key=lambda r: [(v is not None, str(v)) for v in r])


def test_bitmaps_count_as_distinct_values_do(spark):
    keys = spark.range(200_000).select(
        F.when(F.col("id") % 1000 != 0, (F.col("id") * 7 % 90_000 - 40_000)).cast("int").alias("k")
    )
    edges = spark.createDataFrame([(2**31 - 1,), (-(2**31),), (0,)], "k int")
    for df in (keys, edges, keys.limit(0), keys.unionByName(edges)):
        plain = collected(duplicate_checks({"t": (df, "k")}))
        dense = duplicate_checks({"t": (df, "k")}, dense=["t"])
        assert collected(dense) == plain
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "hashpartitioning(k" not in plan


def test_counts_and_newest_days_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "facts")
    moments = spark.range(5_000).select(
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
        .alias("start_time")
    )
    days = moments.withColumn("date_sk", date_sk(F.col("start_time")))
    days.repartitionByRange(6, "date_sk").write.parquet(path)
    footers = footer_scan(spark, path)
    counts = row_counts({"facts": footers})
    assert collected(counts) == [("facts", 5_000)]
    assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()
    newest = footers.agg(F.max("date_sk"))
    assert "PushedAggregation: [MAX(date_sk)]" in newest._jdf.queryExecution().toString()
    table, now = spark.read.parquet(path), dt.datetime(2024, 8, 1)
    lag = freshness_of_days({"facts": (footers, table, "date_sk", "start_time")}, now)
    assert collected(lag) == collected(freshness({"facts": (table, "start_time")}, now))
    assert "EqualTo(date_sk,20240727)" in lag._jdf.queryExecution().toString()
    none = footers.limit(0)
    empty = freshness_of_days({"facts": (none, table, "date_sk", "start_time")}, now)
    assert collected(empty) == [("facts", None, None)]
    # Other scans are planned as before.
    assert "FileScan parquet" in table._jdf.queryExecution().executedPlan().toString()
