"""Surrogate keys: assigning them to dimension rows and looking them up."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from farebox.functions.checks import must, repeated
from farebox.session import cut_lineage

# A bucket holds this many consecutive key values. 32-bit keys fall into at most
# 2**32 / BUCKET_WIDTH = 42,950 buckets, plus one for null keys: that bounds the
# table of bucket offsets, which is broadcast and summed up in one task.
BUCKET_WIDTH = 100_000
# Keys sent to all tasks go in runs of this many consecutive values. A full run takes some 400
# bytes there and one with a single key 100, where a row for each key would take 55 bytes a key.
RUN = 64
# Tables of up to this many rows are sent as they are, and of so many runs as runs: 54 MB at most.
SENT_ROWS = SENT_RUNS = 1 << 17


def assign_surrogate_key(
    df: DataFrame,
    key: str,
    sk: str,
    after: Column | int = 0,
    unique: bool = False,
    first: str | None = None,
) -> DataFrame:
    """Put a dense integer column ``sk`` before the columns of ``df``.

    Rows are numbered after + 1, after + 2, … in the order of ``first``, if it is given,
    then of ``key``, nulls last, then of the other columns. The order is total up to rows
    equal in every column, so the numbers depend on the content alone.

    The caller's contract decides how. An integer ``key`` said to be ``unique``,
    and never null, is ranked in buckets of at most BUCKET_WIDTH rows; it is to be unique
    for each value of ``first``, of which there are few. Any other key is numbered by
    ranges of the full order, whatever the rows are.
    """
    if unique and isinstance(df.schema[key].dataType, IntegerType):
        numbered = _position_by_bucket(df, key, first)
    elif first is None:
        numbered = _position_by_range(df, key)
    else:
        raise ValueError("an order before the key needs a unique integer key")
    start = F.lit(after) if isinstance(after, int) else after
    return numbered.select((start + F.col("_position")).cast("int").alias(sk), *df.columns)


def _full_order(df: DataFrame, key: str) -> list[Column]:
    columns = [key, *[c for c in df.columns if c != key]]
    return [F.col(c).asc_nulls_last() for c in columns]


def _bucket(key: str) -> Column:
    return F.floor(F.col(key) / F.lit(BUCKET_WIDTH)).cast("int")


def _offsets(df: DataFrame, *groups: str) -> DataFrame:
    """Per group, in ascending order with nulls last, the rows of all groups before."""
    before = Window.orderBy(*[F.col(g).asc_nulls_last() for g in groups]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.select(
        *[F.col(g).alias(f"_of{g}") for g in groups],
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )


def _position_by_bucket(df: DataFrame, key: str, first: str | None = None) -> DataFrame:
    rows = df.withColumn("_bucket", _bucket(key))
    groups = ["_bucket"] if first is None else [first, "_bucket"]
    offsets = _offsets(rows, *groups)
    inside = Window.partitionBy(*groups).orderBy(*_full_order(df, key))
    ranked = rows.withColumn("_rank", F.row_number().over(inside))
    met = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_of{g}")) for g in groups])
    return ranked.join(F.broadcast(offsets), met).withColumn(
        "_position", F.col("_before") + F.col("_rank")
    )


def _position_by_range(df: DataFrame, key: str) -> DataFrame:
    """Sort the whole table, count each partition, add up the partitions before.

    The first checkpoint fixes the row order that the tie-breaking ids come from,
    and the second the partition boundaries, which Spark samples: a task run
    again after a lost executor, and the two passes below, see the same rows in
    the same places. The ids part only rows equal in every column, so that even
    copies of a single row spread over the partitions.
    """
    fixed = cut_lineage(df).withColumn("_id", F.monotonically_increasing_id())
    order = [*_full_order(df, key), F.col("_id")]
    in_place = cut_lineage(
        fixed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_partition", F.spark_partition_id())
        # The low 33 bits of the generated id count the rows of the partition.
        .withColumn("_rank", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1)
    )
    # One row per partition.
    offsets = _offsets(in_place, "_partition")
    return in_place.join(
        F.broadcast(offsets), F.col("_partition") == F.col("_of_partition")
    ).withColumn("_position", F.col("_before") + F.col("_rank"))


def keep_surrogate_keys(
    df: DataFrame, known: DataFrame, key: str, sk: str, after: Column | int
) -> DataFrame:
    """Put ``sk`` before the columns of ``df``, the same number for a ``key`` in every load.

    ``known`` has the (key, sk) of all loads before, and ``after`` is the last number given.
    Only keys that are not known get new ones, in their order; ``df`` itself is never ranked.
    A ``key`` is unique in ``df``, and never null.
    """
    # Both sides are about as large, and not sent: the bytes of stored keys are too few to tell.
    fresh = df.join(known.hint("merge"), key, "left_anti").select(key)
    given = assign_surrogate_key(fresh, key, sk, after, unique=True)
    keys = known.select(key, sk).unionByName(given)
    return df.join(keys.hint("merge"), key).select(sk, *df.columns)


@dataclass(frozen=True)
class Sent:
    """Values of integer keys in runs, as they are sent to all tasks."""

    runs: DataFrame


def _place(key: str) -> tuple[Column, Column]:
    """The first value of a key's run, and the key's place in it."""
    whole = F.col(key).cast("bigint")
    place = F.pmod(whole, F.lit(RUN))
    return whole - place, place.cast("tinyint")


def sent_keys(table: DataFrame, key: str, value: str) -> Sent | None:
    """``value`` by integer ``key`` in runs; none if these are too many or a key is repeated.

    The runs are counted by a job of its own. Rows without a key are left out.
    """
    run, place = _place(key)
    keys = table.filter(F.col(key).isNotNull()).select(
        run.alias("_run"), place.alias("_place"), F.col(value).alias("_value")
    )
    # A bit for each place.
    places = F.bit_or(F.expr("shiftleft(1L, CAST(_place AS int))"))
    sizes = keys.groupBy("_run").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_count(places).alias("keys")
    )
    runs, repeated_keys = sizes.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("rows") - F.col("keys")), F.lit(0))
    ).first()
    if runs > SENT_RUNS or repeated_keys:
        return None
    held = F.map_from_entries(F.collect_list(F.struct("_place", "_value")))
    return Sent(keys.groupBy("_run").agg(held.alias("_held")))


def lookup_sent(rows: DataFrame, sent: Sent, key: str, value: str) -> DataFrame:
    """Add the ``value`` of each row's ``key``, null where there is none; no row is moved."""
    run, place = _place(key)
    return (
        rows.join(F.broadcast(sent.runs), run == F.col("_run"), "left")
        .withColumn(value, F.try_element_at("_held", place))
        .drop("_run", "_held")
    )


def lookup_bounded(rows: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` joined to the ``value`` of their integer ``key``, null where there is none.

    As a left join, whatever is repeated; but what is sent to all tasks is bounded by the rows
    there are, which a job counts, and not by the bytes that Spark expects of their files.
    """
    keys = table.select(key, value)
    if keys.count() <= SENT_ROWS:
        return rows.join(keys, key, "left")
    sent = sent_keys(keys, key, value)
    if sent is None:
        return rows.join(keys.hint("merge"), key, "left")
    return lookup_sent(rows, sent, key, value)


def lookup_sk(
    facts: DataFrame, dimension: DataFrame | Sent, key: str, sk: str, unique: bool = False
) -> DataFrame:
    """Add the surrogate key of each row's ``key``, null where there is none.

    No row is lost, and none multiplied: a ``key`` that occurs in more than one row of
    ``dimension`` fails the job, unless the caller has made sure that it is ``unique``. The
    join carries just the two key columns of the dimension; whether it is broadcast follows
    from its measured size, and otherwise adaptive execution splits the partitions of hot
    keys. Keys that are ``Sent`` are those of a dimension that has each once.
    """
    if isinstance(dimension, Sent):
        return lookup_sent(facts, dimension, key, sk)
    keys = dimension.select(key, sk)
    if not unique:
        # One number, found beside the join: a grouping inside it would leave the join to the
        # dimension's own partitions, which adaptive execution cannot split for a hot key.
        named = dimension.filter(F.col(key).isNotNull())
        keys = keys.filter(
            must(repeated(named, key) == 0, f"{key} occurs in several rows of the dimension")
        )
    return facts.join(keys, key, "left")
