import random

import pytest
from helpers import collected
from pyspark.sql import functions as F

from farebox.operators import keys
from farebox.operators.keys import (
    BUCKET_WIDTH,
    assign_surrogate_key,
    keep_surrogate_keys,
    lookup_sk,
)


def numbered(values, after=0):
    """The expected result: sort everything, nulls last, and count."""
    order = sorted(values, key=lambda row: [(v is None, v if v is not None else 0) for v in row])
    return [(after + i, *row) for i, row in enumerate(order, start=1)]


def by_key(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def sparse():
    pick = random.Random(5)
    keys = pick.sample(range(-5 * BUCKET_WIDTH, 40 * BUCKET_WIDTH), 1500)
    return [(key, f"n{pick.randrange(50)}") for key in keys]


@pytest.fixture(scope="module")
def repeated(sparse):
    """A third of the rows has one key, a third none, and there are exact copies."""
    hot = [(sparse[0][0], f"h{i % 700}") for i in range(1500)]
    return sparse + hot + [(None, f"m{i % 600}") for i in range(1500)]


def frame(spark, values):
    return spark.createDataFrame(values, "id int, name string")


@pytest.mark.parametrize("unique", [True, False])
def test_sparse_and_negative_keys(spark, sparse, unique):
    df = frame(spark, sparse).repartition(9)
    assert by_key(assign_surrogate_key(df, "id", "sk", unique=unique)) == numbered(sparse)


@pytest.mark.parametrize("partitions", [1, 13])
def test_repeated_and_null_keys(spark, repeated, partitions):
    df = frame(spark, repeated).repartition(partitions)
    assert by_key(assign_surrogate_key(df, "id", "sk", after=70)) == numbered(repeated, 70)


def test_copies_of_one_row_spread_over_tasks(spark, monkeypatch):
    sizes = []
    from farebox.operators import keys

    cut = keys.cut_lineage

    def watch(df):
        result = cut(df)
        if "_partition" in result.columns:
            sizes.extend(r["count"] for r in result.groupBy("_partition").count().collect())
        return result

    monkeypatch.setattr(keys, "cut_lineage", watch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.lit(5).alias("id"), F.lit("same").alias("name"))
        keyed = assign_surrogate_key(df, "id", "sk")
        assert [row[0] for row in by_key(keyed)] == list(range(1, 4001))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 4000


def test_other_key_types(spark):
    codes = spark.createDataFrame([("b",), (None,), ("a",)], "code string")
    assert by_key(assign_surrogate_key(codes, "code", "sk")) == [(1, "a"), (2, "b"), (3, None)]
    wide = spark.createDataFrame([(2**50,), (-(2**50),), (3,)], "id long")
    assert by_key(assign_surrogate_key(wide, "id", "sk")) == [(1, -(2**50)), (2, 3), (3, 2**50)]


@pytest.mark.parametrize("unique", [True, False])
def test_empty(spark, unique):
    empty = spark.createDataFrame([], "id int, name string")
    assert assign_surrogate_key(empty, "id", "sk", unique=unique).count() == 0


def test_lookup_keeps_every_row(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 9), ("c", None)], "fact string, id int")
    dimension = spark.createDataFrame(
        [(11, 1, "x"), (13, None, "z"), (14, None, "z")], "sk int, id int, name string"
    )
    assert collected(lookup_sk(facts, dimension, "id", "sk"), "fact", "sk") == [
        ("a", 11),
        ("b", None),
        ("c", None),
    ]


def test_lookup_refuses_a_repeated_key(spark):
    facts = spark.createDataFrame([("a", 1)], "fact string, id int")
    dimension = spark.createDataFrame([(11, 1), (12, 1)], "sk int, id int")
    with pytest.raises(Exception, match="id occurs in several rows of the dimension"):
        lookup_sk(facts, dimension, "id", "sk").collect()


def test_keys_sent_in_runs(spark):
    """Negative, sparse, missing and null keys, and one whose value is null."""
    table = spark.createDataFrame(
        [(-65, 1), (-64, 2), (-1, 3), (0, 4), (63, 5), (64, 6), (2**31 - 1, 7), (9, None), (None, 8)],
        "id int, sk int",
    )
    facts = spark.createDataFrame(
        [(-65,), (-64,), (-1,), (0,), (63,), (64,), (2**31 - 1,), (9,), (None,), (1,), (500,), (0,)],
        "id int",
    )
    sent = keys.sent_keys(table, "id", "sk")
    assert sent.runs.count() == 5
    assert collected(lookup_sk(facts, sent, "id", "sk"), "id", "sk") == collected(
        lookup_sk(facts, table, "id", "sk", unique=True), "id", "sk"
    )


def test_keys_repeated_or_in_too_many_runs_are_not_sent(spark, monkeypatch):
    once = spark.createDataFrame([(1, 1), (200, 2), (None, 3), (None, 4)], "id int, sk int")
    assert keys.sent_keys(once, "id", "sk") is not None
    assert keys.sent_keys(once.unionByName(once.limit(1)), "id", "sk") is None
    monkeypatch.setattr(keys, "SENT_RUNS", 1)
    assert keys.sent_keys(once, "id", "sk") is None


@pytest.mark.parametrize("sent_rows", [0, 1 << 17])
def test_a_bounded_lookup_is_a_left_join(spark, monkeypatch, sent_rows):
    monkeypatch.setattr(keys, "SENT_ROWS", sent_rows)
    facts = spark.createDataFrame([("a", 1), ("b", 9), ("c", None)], "fact string, id long")
    once = spark.createDataFrame([(1, 11), (None, 12)], "id long, sk int")
    for table, found in ((once, [("a", 11)]), (once.unionByName(once), [("a", 11), ("a", 11)])):
        looked_up = keys.lookup_bounded(facts, table, "id", "sk")
        assert collected(looked_up, "fact", "sk") == [*found, ("b", None), ("c", None)]


def test_stored_keys_are_not_sent_for_their_few_bytes(spark, tmp_path):
    path = str(tmp_path / "known")
    spark.range(50_000).selectExpr(
        "CAST(id AS int) AS user_id", "CAST(id + 1 AS int) AS user_sk"
    ).write.parquet(path, compression="zstd")
    known = spark.read.parquet(path)
    users = spark.range(60_000).selectExpr("CAST(id AS int) AS user_id", "'x' AS name")
    kept = keep_surrogate_keys(users, known, "user_id", "user_sk", 50_000)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # But for the offsets of buckets.
    assert plan.count("BroadcastHashJoin") == 1 and "LeftAnti" in plan
    assert kept.filter("user_sk = user_id + 1").count() == 60_000


def test_known_keys_stay_and_new_ones_follow(rows):
    known = rows("user_id int, user_sk int", (10, 1), (30, 2), (50, 3))
    users = rows("user_id int, name string", (50, "e"), (20, "b"), (10, "a"), (40, "d"))
    kept = keep_surrogate_keys(users, known, "user_id", "user_sk", after=7)
    assert collected(kept, "user_id", "user_sk") == [(10, 1), (20, 8), (40, 9), (50, 3)]
    assert kept.columns == ["user_sk", "user_id", "name"]


def test_only_new_keys_are_ranked(spark, rows):
    users = spark.range(1000).select(F.col("id").cast("int").alias("user_id"), F.lit("x").alias("name"))
    known = users.filter("user_id % 2 = 0").selectExpr("user_id", "user_id + 1 AS user_sk")
    plan = keep_surrogate_keys(users, known, "user_id", "user_sk", 1000)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    ranked = text[text.index("row_number()") :]
    # What is ranked is the anti join's rows, of the key alone.
    assert "LeftAnti" in ranked and "name" not in ranked
    assert plan.count() == 1000


def test_keys_within_days(rows):
    versions = rows("day int, route_id int", (2, 1), (1, 9), (1, 200_000), (2, 9))
    keyed = assign_surrogate_key(versions, "route_id", "sk", 10, unique=True, first="day")
    assert collected(keyed, "sk", "day", "route_id") == [
        (11, 1, 9), (12, 1, 200_000), (13, 2, 1), (14, 2, 9),
    ]
    with pytest.raises(ValueError, match="unique integer key"):
        assign_surrogate_key(versions, "route_id", "sk", first="day")
