"""Sinks for warehouse and mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farebox.functions.dates import month_key
from farebox.schemas import USER_BEHAVIOR_HOURLY, conform

# Fixed value: the mart's sort key, coarsest first.
MART_SORT_KEY = ("full_date", "hour_of_day", "city", "route_number", "payment_method")
# Tables are written once and read several times: smaller files than Spark's default codec gives.
COMPRESSION = "zstd"


def write_table(df: DataFrame, path: str, schema: StructType, mode: str = "overwrite") -> int:
    """Write ``df`` as Parquet in the columns and types of ``schema``.

    Returns the number of rows written, counted while writing.
    """
    written = Observation()
    rows = conform(df, schema).observe(written, F.count(F.lit(1)).alias("rows"))
    rows.write.mode(mode).parquet(path, compression=COMPRESSION)
    return written.get["rows"]


def write_bucketed_table(
    df: DataFrame, name: str, path: str, schema: StructType, key: str, buckets: int
) -> None:
    """Write a catalog table hashed and sorted by ``key``.

    Two facts bucketed alike by ride_id join without a shuffle.
    """
    (
        conform(df, schema)
        .repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )


def mart_layout(mart: DataFrame) -> DataFrame:
    """The hourly mart with its month, as partitions ready to be written.

    Rows are brought together by day, not by month: a month would be one task
    however large it is. Days are rebalanced, so adaptive execution splits a
    heavy one over several tasks and merges light ones.
    """
    return (
        conform(mart, USER_BEHAVIOR_HOURLY)
        .withColumn("yyyymm", month_key(F.col("full_date")))
        .hint("rebalance", "yyyymm", "full_date")
        .sortWithinPartitions("yyyymm", *MART_SORT_KEY)
    )


def day_layout(facts: DataFrame, day: str) -> DataFrame:
    """Rows as partitions ready to be written to a folder for each ``day``.

    Brought together by day and rebalanced: adaptive execution splits a heavy day over
    several tasks and merges light ones, so that there are few files and none is huge.
    """
    return facts.hint("rebalance", day)


def write_mart(mart: DataFrame, path: str) -> int:
    """Write the hourly mart: one folder per month, sorted files inside."""
    written = Observation()
    rows = mart_layout(mart).observe(written, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").partitionBy("yyyymm").parquet(path)
    return written.get["rows"]
