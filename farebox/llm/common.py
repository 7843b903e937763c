"""Helpers shared by the operators of this package."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.files import opened
from farebox.session import shared_folder

# Whole texts are worked on in groups of about this many bytes: the arrays a task
# holds stay small, and in the processor's cache, however many rows a batch has.
SLICE_BYTES = 1 << 19


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the cluster's shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Later steps do not depend on the executors that computed it.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it, that is no column of ``df`` in any letter case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(df: DataFrame, name: str) -> Column:
    return df[f"`{name}`"]


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns called c0, c1, …, whatever characters their names have."""
    return df.toDF(*[f"c{n}" for n in range(len(df.columns))])


def ship(spark: SparkSession) -> None:
    """Make this library importable in the executors' Python, once per application.

    Spark fetches the archive from the shared folder for each executor.
    """
    if spark.sparkContext.applicationId not in _shipped:
        _shipped.add(spark.sparkContext.applicationId)
        package = Path(__file__).parent.parent
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        folder = new_folder(spark, "code")
        system, path = opened(folder)
        system.create_dir(path)
        with system.open_output_stream(f"{path}/{package.name}.zip") as out:
            out.write(content.getvalue())
        spark.sparkContext.addPyFile(f"{folder}/{package.name}.zip")


_shipped: set[str] = set()


def identity(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes that tell rows apart; equal for rows that are equal in every column."""
    columns = [column(df, c) for c in df.columns]
    nulls = [c.isNull() for c in columns]
    return F.xxhash64(*columns, *nulls), F.xxhash64(F.lit(1), *nulls, *columns)


def slices(
    batches: Iterable[pa.RecordBatch], name: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts in a row, as a dictionary, and where each text's words begin.

    A word is a run of characters other than space and the controls 9 to 13. Nulls
    and texts without a word have none. The second array has one more entry than
    there are texts.
    """
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = parts.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)))
    offsets = parts.offsets.to_numpy().astype(np.int64)
    return flat.filter(real).dictionary_encode(), before[offsets - offsets[0]]


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each element, the number of the text it belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a multiply-and-shift finaliser)."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive token hashes, by its first position."""
    count = len(tokens) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total += tokens[place : place + count] * factors[place]
    return mixed(total)
