"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import column, fresh, identity, stored
from farebox.llm.simhash import once_per_task

# The weights of the sources in order, and how often a text may be taken.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
# Texts that one task rounds in a row, and residuals that one task combines.
BLOCK_ROWS = 2_000
SEED = 7
WHOLE = 1e-9


def word_count(text: Column) -> Column:
    """Runs of characters other than space and the controls 9 to 13; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sources(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight): sources by code point, null last, weigh 1, 2, 3, ….

    The place of a source is found by ranges, so that no task sorts all of them.
    """
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    order = [F.col("source").asc_nulls_last()]
    placed = stored(
        totals.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "sources",
    )
    # One row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    )
    place = (F.col("start") + F.col("place")) % len(WEIGHTS)
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    return placed.join(F.broadcast(starts), "part").select(
        "source", "source_size", F.get(weights, place.cast("int")).alias("weight")
    )


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) of ``sizes`` (source, size).

    Sources share the sum of all sizes by weight. Shares above three times the source's
    size stop there; what they leave is shared by weight among the others, until none
    is above. Each round reads one row of sums.
    """
    weighed = stored(sources(sizes), "weights")
    cap = F.col("source_size") * MOST_COPIES
    rate, stopped = 0.0, -1
    while True:
        above = cap < F.col("weight") * rate
        row = weighed.agg(
            F.sum("source_size"),
            F.sum(F.when(above, cap)),
            F.sum(F.when(~above, F.col("weight"))),
            F.count_if(above),
        ).first()
        total, full, open_weight, count = (row[0] or 0, row[1] or 0, row[2] or 0, row[3])
        if count == stopped or not open_weight:
            break
        stopped, rate = count, (total - full) / open_weight
    share = F.least(cap.cast("double"), F.col("weight") * F.lit(float(rate)))
    return weighed.select("source", "source_size", share.alias("target"))


def pair(p: float, a: int, q: float, b: int, luck: float) -> tuple[float, float]:
    """Move mass between two fractions until one is whole; p*a + q*b and means stay.

    ``luck`` is uniform in [0, 1).
    """
    up = min(a * (1 - p), b * q)
    down = min(a * p, b * (1 - q))
    if luck * (up + down) < down:
        p, q = p + up / a, q - up / b
    else:
        p, q = p - down / a, q + down / b
    return _settled(p), _settled(q)


def _settled(p: float) -> float:
    return float(round(p)) if abs(p - round(p)) < WHOLE else p


def luck(*names) -> float:
    """A number in [0, 1) that depends on the names alone."""
    return xxhash.xxh64_intdigest(repr((SEED, *names))) / 2.0**64


def _round_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round runs of equal (source, block), rows sorted; one fraction is left in each run.

    Sees (run, h1, h2, size, p) and gives (h1, h2, p): p is 0 or 1, but for the last
    text of a run that is still open.
    """
    held = None

    def result(rows):
        h1, h2, p = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(p, pa.float64())],
            ["h1", "h2", "p"],
        )

    for batch in batches:
        done = []
        columns = [c.to_pylist() for c in batch.columns]
        for run, h1, h2, size, p in zip(*columns, strict=True):
            if held and held[0] != run:
                done.append((held[1], held[2], held[4]))
                held = None
            if held is None:
                held = (run, h1, h2, size, p)
                continue
            mine, other = pair(held[4], held[3], p, size, luck(held[1], held[2], h1, h2))
            if 0 < other < 1:
                done.append((held[1], held[2], mine))
                held = (run, h1, h2, size, other)
            else:
                done.append((h1, h2, other))
                held = (run, held[1], held[2], held[3], mine)
                if not 0 < mine < 1:
                    done.append((held[1], held[2], mine))
                    held = None
        yield result(done)
    if held:
        yield result([(held[1], held[2], held[4])])


def rounded(fractions: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(h1, h2, p) with p 0 or 1 for each of ``fractions`` (source, h1, h2, size, p).

    A reduction tree: the texts of a source are dealt into blocks by their hashes, each
    block is rounded but for one text, and those go to the next level, until a source
    fits a block. Long texts come first in a block, so that the one left is short as a
    rule; the fraction left at the top is drawn by its own chance. Blocks depend on counts and hashes alone, so that reruns agree however rows are placed.
    """
    frame = fractions.sparkSession
    level, done = 0, []
    open_rows = stored(fractions, "fractions")
    while True:
        counts = open_rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
        most = counts.agg(F.max("rows")).first()[0] or 0
        counts = counts.select(
            F.col("source").alias("s"), F.ceil(F.col("rows") / block_rows).alias("blocks")
        )
        dealt = (
            open_rows.join(counts, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("block", F.pmod(F.xxhash64(F.lit(level), "h1", "h2"), F.col("blocks")))
            .withColumn("run", F.xxhash64("source", F.col("source").isNull(), "block"))
        )
        ready = (
            dealt.repartition("source", "block")
            .sortWithinPartitions("run", "source", "block", F.desc("size"), "h1", "h2")
            .select("run", "h1", "h2", "size", "p")
        )
        out = stored(ready.mapInArrow(_round_rows, "h1 long, h2 long, p double"), "rounded")
        whole = (F.col("p") == 0) | (F.col("p") == 1)
        done.append(out.filter(whole))
        left = open_rows.drop("p").join(out.filter(~whole), ["h1", "h2"])
        if most <= block_rows:
            break
        open_rows, level = stored(left, "fractions"), level + 1
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "h1", "h2"), F.lit(1 << 32)) / F.lit(2.0**32)
    done.append(left.select("h1", "h2", (drawn < F.col("p")).cast("double").alias("p")))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def decisions(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """How often each document is taken: one row for each group of wholly equal rows.

    Returns (h1, h2, id, rows, size, source_size, target, copies): ``copies`` is for all
    ``rows`` of the group together, at most three for each. A source's expected copies
    are its target over its size; whole parts are taken, and fractions rounded so that
    the words taken of a source stay what they were but for one text.
    """
    h1, h2 = identity(docs)
    narrow = stored(
        docs.select(
            h1.alias("h1"),
            h2.alias("h2"),
            column(docs, id_column).alias("id"),
            column(docs, source_column).cast("string").alias("source"),
            word_count(column(docs, text_column).cast("string")).alias("size"),
        )
        .groupBy("h1", "h2", "id", "source", "size")
        .agg(F.count(F.lit(1)).alias("rows")),
        "sizes",
    )
    shares = targets(narrow.select("source", (F.col("size") * F.col("rows")).alias("size")))
    goal = shares.withColumnRenamed("source", "s")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("rows"))
    joined = (
        narrow.join(goal, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("wanted", F.coalesce(wanted, F.lit(0.0)))
        .withColumn("base", F.floor(F.col("wanted") + WHOLE))
        .withColumn("p", F.greatest(F.col("wanted") - F.col("base"), F.lit(0.0)))
    )
    open_rows = joined.filter((F.col("p") > WHOLE) & (F.col("size") > 0))
    chosen = rounded(open_rows.select("source", "h1", "h2", "size", "p"))
    extra = F.coalesce(F.col("p"), F.lit(0.0)).cast("long")
    return (
        joined.drop("p")
        .join(chosen, ["h1", "h2"], "left")
        .select(
            "h1", "h2", "id", "rows", "size", "source_size", "target",
            (F.col("base") + extra).alias("copies"),
        )
    )


def mixed_sizes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """(id, size, source_size, target, taken) for every row of ``docs``.

    Null and empty texts have size 0 and none of their words is taken. A null source is a
    source of its own. Of equal rows the first ones take one copy more where their
    copies do not divide. An empty table gives no rows.
    """
    each = F.col("copies") / F.col("rows")
    place = decisions(docs, id_column, text_column, source_column).withColumn(
        "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    )
    share = F.floor(each) + (F.col("n") <= F.col("copies") % F.col("rows")).cast("long")
    return place.select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        (F.col("size") * share).alias("taken"),
    )


def mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The documents of the mix in the columns of ``docs``, each as often as it is taken."""
    a, b, n = fresh(docs, "h1"), fresh(docs, "h2"), fresh(docs, "copies")
    h1, h2 = identity(docs)
    taken = decisions(docs, id_column, text_column, source_column).filter("copies > 0")
    taken = taken.select(F.col("h1").alias(a), F.col("h2").alias(b), F.col("copies").alias(n))
    once = once_per_task(docs.withColumn(a, h1).withColumn(b, h2), a).join(taken, [a, b])
    every = F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))
    return once.dropDuplicates([a, b]).withColumn(n, every).drop(a, b, n)
