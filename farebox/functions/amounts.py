"""Sums and means of money and other numbers with two decimals.

Amounts are counted in whole hundredths, in 64 bits, where a sum that does not fit
is an error. Adding and dividing wide decimals takes several times longer, which
shows in a mart of nearly as many rows as its facts. A sum and a count can be
merged where a mean cannot, so an operator may aggregate before it joins and again
afterwards, with exactly the result of a single aggregation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def hundredths(value: Column) -> Column:
    """A decimal with two digits after the point as a whole number."""
    return (value * 100).cast("bigint")


def amount(total: Column, kind: DecimalType) -> Column:
    """The decimal that many hundredths make up."""
    return (total.cast(DecimalType(18, 0)) * F.lit(Decimal("0.01"))).cast(kind)


def rounded_mean(total: Column, count: Column, kind: DecimalType) -> Column:
    """The mean of hundredths rounded half up to ``kind``; null for no rows."""
    size = _whole_quotient(F.abs(total) * 2 + count, count * 2)
    return amount(F.when(total < 0, -size).otherwise(size), kind)


def truncated_mean(total: Column, count: Column) -> Column:
    """The integer part of a mean of whole numbers; null for no rows."""
    return _whole_quotient(total, count).cast("int")


def _whole_quotient(dividend: Column, divisor: Column) -> Column:
    return F.call_function("div", dividend, divisor)
