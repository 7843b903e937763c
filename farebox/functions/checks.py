"""Conditions that rows have to meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def must(condition: Column, message: str) -> Column:
    """A filter that keeps every row, and fails on one that breaks the condition."""
    return F.assert_true(condition, message).isNull()


def repeated(df: DataFrame, key: str) -> Column:
    """How many values of ``key``, null being one, occur more than once: one number."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count_if(F.col("n") > 1)).scalar()
