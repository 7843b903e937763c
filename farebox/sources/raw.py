"""Table scans by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed value: the only file format of the raw and processed zones.
FORMATS = ("parquet",)


def read_raw(spark: SparkSession, root: str, table: str, file_format: str = "parquet") -> DataFrame:
    """Scan the dataset stored under ``root/table``."""
    if file_format not in FORMATS:
        raise ValueError(f"Unsupported format: {file_format}")
    return spark.read.format(file_format).load(f"{root.rstrip('/')}/{table}")


def footer_scan(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet tables as a scan that answers counts and extremes from the file footers.

    Counts of rows, and least and greatest values of numbers, days and flags without a filter
    but on folders, then read no data pages. Needs ``spark.sql.parquet.aggregatePushdown``.
    """
    setting = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(setting)
    kept = [name for name in before.split(",") if name != "parquet"]
    spark.conf.set(setting, ",".join(kept))
    try:
        return spark.read.parquet(*paths)
    finally:
        spark.conf.set(setting, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = file_system(spark, path)
    return system.exists(hadoop_path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or no rows of ``schema`` where nothing is there.

    Only absence yields the empty table; an unreadable one is an error.
    """
    if path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path
