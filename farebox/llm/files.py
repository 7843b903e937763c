"""Files that tasks write to a shared folder, and their manifest."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and the folder's path there.

    Folders are given as Spark has them: a URI, or a path on the shared file system. Schemes
    that only Hadoop knows are opened as what they stand for: s3a and s3n as s3, and dbfs as the
    folder it is mounted on.
    """
    folder = re.sub(r"^file:/+", "/", folder)
    folder = re.sub(r"^s3[an]://", "s3://", folder)
    folder = re.sub(r"^dbfs:/+", "/dbfs/", folder)
    return fs.FileSystem.from_uri(folder)


def output_name(suffix: str) -> Callable[[], str]:
    """Names for the files of one attempt of a task: in order, and no other attempt's."""
    part = TaskContext.get().partitionId()
    attempt = uuid.uuid4().hex
    count = iter(range(1 << 30))
    return lambda: f"part-{part:06d}-{next(count):06d}-{attempt}{suffix}"


def committed(listing: DataFrame, path: str) -> DataFrame:
    """Run the writing tasks behind ``listing`` and keep the rows of those that succeeded.

    Spark commits the rows of one attempt for each task, so files of attempts that were
    lost are never listed, whether or not they are whole.
    """
    listing.write.parquet(path)
    return listing.sparkSession.read.schema(listing.schema).parquet(path)


def spread(manifest: DataFrame, size: str, target: int) -> DataFrame:
    """The manifest dealt out so that a task reads files of about ``target`` bytes in all."""
    total, files = manifest.agg(F.sum(size), F.count(F.lit(1))).first()
    tasks = max(math.ceil((total or 0) / target), min(files, _cores(manifest)))
    return manifest.repartition(max(1, tasks))


def _cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism
