import datetime as dt
import random
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from farebox.functions.amounts import amount, hundredths, rounded_mean, truncated_mean
from farebox.functions.dates import date_sk, moment_or_now, month_key, seconds_between
from farebox.schemas import MONEY, TOTAL


def test_means_match_exact_arithmetic(spark):
    pick = random.Random(3)
    values = [(s, c) for c in (1, 2, 3, 7, 8, 200) for s in range(-40, 41)]
    values += [(pick.randrange(-(10**15), 10**15), pick.randrange(1, 10**9)) for _ in range(500)]
    values += [(10**17 + 1, 2), (-(10**17) - 1, 2)]
    df = spark.createDataFrame(values, "s long, c long").select(
        "s",
        "c",
        rounded_mean(F.col("s"), F.col("c"), TOTAL).alias("rounded"),
        truncated_mean(F.col("s") % 10**9, F.col("c")).alias("truncated"),
        amount(F.col("s"), TOTAL).alias("amount"),
    )
    assert df.schema["rounded"].dataType == TOTAL
    for s, c, rounded, truncated, whole in df.collect():
        cents = (Decimal(s) / c).quantize(Decimal(1), ROUND_HALF_UP)
        assert rounded == cents / 100
        rest = abs(s) % 10**9 * (1 if s >= 0 else -1)
        assert truncated == int((Decimal(rest) / c).quantize(Decimal(1), ROUND_DOWN))
        assert whole == Decimal(s) / 100


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None, 0)], "s long, c long")
    means = df.select(rounded_mean(F.col("s"), F.col("c"), TOTAL), truncated_mean(F.col("s"), F.col("c")))
    assert tuple(means.first()) == (None, None)


def test_hundredths_are_exact(spark):
    values = [Decimal("99999999.99"), Decimal("-0.01"), Decimal("0.29"), None]
    df = spark.createDataFrame([(v,) for v in values], f"x {MONEY.simpleString()}")
    found = [r[0] for r in df.select(hundredths(F.col("x"))).collect()]
    assert found == [9999999999, -1, 29, None]


def test_overflow_is_an_error(spark):
    df = spark.createDataFrame([(2**62,), (2**62,)], "x long")
    with pytest.raises(PySparkException):
        df.agg(F.sum("x")).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Europe/Berlin"])
def test_dates_do_not_depend_on_the_zone(spark, zone):
    """The moments lie in gaps that daylight saving leaves in the two zones."""
    moments = [dt.datetime(2018, 11, 4, 0, 30), dt.datetime(2024, 3, 31, 2, 30), None]
    later = dt.datetime(2024, 12, 31, 23, 59, 59)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
        found = df.select(
            date_sk(F.col("t")),
            month_key(F.col("t").cast("date")),
            seconds_between(F.col("t"), moment_or_now(later)),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    seconds = [int((later - m).total_seconds()) for m in moments[:2]]
    assert [tuple(r) for r in found] == [
        (20181104, 201811, seconds[0]),
        (20240331, 202403, seconds[1]),
        (None, None, None),
    ]
