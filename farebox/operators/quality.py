"""Data-quality checks and their log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions.dates import moment_or_now, seconds_between
from farebox.schemas import QUALITY_LOG, conform


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """The number of rows of each table."""
    return _union(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    )


def null_checks(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """The number of nulls in each listed column; a table is scanned once."""

    def check(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        rows = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.col(c).alias("null_count"),
                F.lit(f"{c} is null").alias("check_type"),
            )
            for c in columns
        ]
        return counts.select(F.inline(F.array(*rows)))

    return _union(check(name, df, columns) for name, (df, columns) in tables.items())


def freshness(
    tables: dict[str, tuple[DataFrame, str]], now: dt.datetime | None = None
) -> DataFrame:
    """The latest moment in a column of each table and its age in seconds."""
    return _union(
        df.agg(F.max(column).cast("timestamp_ntz").alias("latest_record")).select(
            F.lit(name).alias("table_name"),
            "latest_record",
            seconds_between(F.col("latest_record"), moment_or_now(now)).alias("data_lag"),
        )
        for name, (df, column) in tables.items()
    )


def freshness_of_days(
    tables: dict[str, tuple[DataFrame, DataFrame, str, str]], now: dt.datetime | None = None
) -> DataFrame:
    """``freshness`` of tables with a day for each moment, from their newest day alone.

    For each table: a scan that answers the greatest day from file footers, the table, its
    day and its moment. The day is found right here; the table's scan skips all others.
    """
    newest = {}
    for name, (footers, df, day, column) in tables.items():
        last = footers.agg(F.max(day)).first()[0]
        newest[name] = (df.filter(F.col(day) == F.lit(last)), column)
    return freshness(newest, now)


def duplicate_checks(
    tables: dict[str, tuple[DataFrame, str]], dense: Iterable[str] = ()
) -> DataFrame:
    """Rows beyond the first of each key value; every null key counts as one.

    The tables in ``dense`` have integer keys that lie close together, as numbers given one
    after another do. Theirs are counted by bitmaps of 32,768 values each, which add up:
    tasks send a few KB for each such range of values instead of the values.
    """

    def distinct(name: str, df: DataFrame, key: str) -> DataFrame:
        if name not in dense:
            return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(key)).alias("keys"))
        # Values below zero have ranges of their own.
        value = F.col(key).cast("bigint") + (1 << 31)
        ranges = df.groupBy(F.bitmap_bucket_number(value).alias("range")).agg(
            F.count(F.lit(1)).alias("n"),
            F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"),
        )
        held = F.when(F.col("range").isNotNull(), F.bitmap_count("bits")).otherwise(0)
        return ranges.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(held), F.lit(0)).alias("keys")
        )

    return _union(
        distinct(name, df, key).select(
            F.lit(name).alias("table_name"), (F.col("n") - F.col("keys")).alias("duplicate_count")
        )
        for name, (df, key) in tables.items()
    )


def quality_log(
    nulls: DataFrame | None,
    lags: DataFrame | None,
    duplicates: DataFrame | None,
    max_lag_seconds: int,
    check_date: dt.datetime | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """All check results as log rows: PASS or FAIL.

    A count passes at 0, a lag up to ``max_lag_seconds``; the lag of an empty
    table is unknown and fails. Checks that were not made are None.
    """

    def entries(checks: DataFrame, check_type: Column, result: str, limit: int) -> DataFrame:
        passed = F.coalesce(F.col(result) <= limit, F.lit(False))
        return checks.select(
            "table_name",
            check_type.alias("check_type"),
            F.col(result).cast("string").alias("result_value"),
            F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        )

    made = [
        (nulls, F.col("check_type"), "null_count", 0),
        (lags, F.lit("freshness"), "data_lag", max_lag_seconds),
        (duplicates, F.lit("duplicates"), "duplicate_count", 0),
    ]
    results = [entries(*check) for check in made if check[0] is not None]
    if not results:
        return spark.createDataFrame([], QUALITY_LOG)
    dated = _union(results).withColumn("check_date", moment_or_now(check_date))
    return conform(dated, QUALITY_LOG)


def failed_checks(log: DataFrame) -> DataFrame:
    """The log rows somebody should look at."""
    return log.filter(F.col("status") == "FAIL")


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
