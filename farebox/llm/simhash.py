"""SimHash near-duplicates with pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import column, fresh, identity, numbered, stored
from farebox.llm.components import LINKS, components

BITS = 64
SEED = 42
# Reference fingerprints whose Hamming distances make up the pivot table. A fingerprint's
# row of it is as many bytes, in long columns of eight.
PIVOTS = [xxhash.xxh64_intdigest(f"pivot {n}", seed=SEED) for n in range(16)]
TABLE = [f"distances_{n}" for n in range(len(PIVOTS) // 8)]
# Fingerprints that agree in a key are compared by one task up to this many; beyond
# it they are dealt out again by finer keys, under which no group can be larger.
GROUP_ROWS = 4096
FINE_BITS = 4


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The SimHash of a text, unsigned.

    Words are runs of characters other than space and the controls 9 to 13, A-Z
    lower-cased. Every shingle counts as often as it occurs; a text of fewer words is
    one shingle, and one without words, or null, has fingerprint 0. A bit is set if
    more than half of the shingle hashes have it.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = [end - 1 for end in accumulate(len(word) + 1 for word in words)]
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    last = ends[shingle_words - 1 :] or ends[-1:]
    hashes = np.array(
        [digest(line[s:e], SEED) for s, e in zip(starts, last, strict=False)], dtype=">u8"
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority).view(">u8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 3
) -> DataFrame:
    """(id, row_hash, fingerprint as a signed long) of every document.

    ``row_hash`` is equal for rows equal in every column.
    """
    rows = docs.select(
        column(docs, id_column).cast("long").alias("id"),
        identity(docs)[0].alias("row_hash"),
        column(docs, text_column).cast("string").alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(text.as_py(), shingle_words) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("row_hash"),
                    pa.array(np.array(marks, dtype=np.uint64).view(np.int64)),
                ],
                ["id", "row_hash", "fingerprint"],
            )

    return rows.mapInArrow(work, "id long, row_hash long, fingerprint long")


def key_masks(max_bits: int) -> list[int]:
    """Masks of which at least one hides every difference of up to ``max_bits`` bits.

    The fingerprint is cut into twice as many blocks as bits may differ; each mask
    keeps half of the blocks.
    """
    blocks = max(1, 2 * max_bits)
    cuts = [BITS * n // blocks for n in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return [sum(kept) for kept in combinations(parts, blocks - max_bits)]


def fine_masks(mask: int, max_bits: int) -> list[int]:
    """Masks within ``mask`` and all but ``max_bits`` small blocks of the bits it hides.

    Fingerprints equal under one of these differ in FINE_BITS * max_bits places at
    most, so that a group has at most 2 to that power of them (4096 for 3 bits).
    """
    hidden = [bit for bit in range(BITS) if not mask >> bit & 1]
    parts = [
        sum(1 << bit for bit in hidden[n : n + FINE_BITS]) for n in range(0, len(hidden), FINE_BITS)
    ]
    if len(parts) <= max_bits:
        return [mask]
    return [mask | sum(kept) for kept in combinations(parts, len(parts) - max_bits)]


def signed(value: int) -> int:
    """The signed number with the bits of an unsigned one of 64."""
    return value - (1 << BITS) if value >> (BITS - 1) else value


def with_distances(marks: DataFrame) -> DataFrame:
    """Add the pivot table: the Hamming distance of ``fingerprint`` to each reference."""

    def distance(place: int) -> Column:
        apart = F.bit_count(F.col("fingerprint").bitwiseXOR(F.lit(signed(PIVOTS[place]))))
        return F.shiftleft(apart.cast("long"), 8 * (place % 8))

    packed = {
        name: reduce(Column.bitwiseOR, map(distance, range(8 * n, 8 * n + 8)))
        for n, name in enumerate(TABLE)
    }
    return marks.withColumns(packed)


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


def group_links(marks: np.ndarray, packed: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the fingerprints of one group as all close pairs would.

    ``packed`` has the rows of the pivot table that belong to ``marks``. Two
    fingerprints within ``max_bits`` differ by no more than that in every coordinate,
    so pairs whose largest coordinate difference is greater are discarded. Rows are
    sorted by the first coordinate, so that only a window of them is looked at. The
    pairs that survive are verified by their Hamming distance.
    """
    values = marks.view(np.uint64)
    table = packed.view(np.uint8).astype(np.int16)
    if len(values) == 2:
        near = np.abs(table[0] - table[1]).max() <= max_bits
        near = near and int(popcount(values[0] ^ values[1])) <= max_bits
        return [(int(marks[0]), int(marks[1]))] if near else []
    order = np.argsort(table[:, 0], kind="stable")
    table, values = table[order], values[order]
    first = table[:, 0]
    stops = np.searchsorted(first, first + max_bits, side="right")
    label = np.arange(len(values))
    for row, stop in enumerate(stops):
        inside = np.arange(row + 1, stop)
        inside = inside[label[inside] != label[row]]
        if not len(inside):
            continue
        apart = np.abs(table[inside] - table[row]).max(axis=1)
        inside = inside[apart <= max_bits]
        inside = inside[popcount(values[inside] ^ values[row]) <= max_bits]
        for other in np.unique(label[inside]):
            label[label == other] = label[row]
    signed = values.view(np.int64)
    links = []
    for name in np.unique(label):
        members = np.sort(signed[label == name])
        links += [(int(m), int(members[0])) for m in members[1:]]
    return links


def _runs(max_bits: int, limit: int):
    """Links within runs of equal (slot, key); members of longer runs with a null for ``b``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = keys = marks = np.zeros(0, np.int64)
        table = np.zeros((0, len(TABLE)), np.int64)
        large = False

        def result(links, members):
            """``members`` are pieces of (marks, slots, rows of the table)."""
            of_runs = [np.concatenate(part) for part in zip(*members, strict=True)]
            left, at, rows = of_runs or (marks[:0], slots[:0], table[:0])
            a, b = np.array(links, np.int64).reshape(-1, 2).T
            none = pa.nulls(len(links), pa.int64())
            columns = [
                (pa.array(a), pa.array(left)),
                (pa.array(b), pa.nulls(len(left), pa.int64())),
                (none, pa.array(at)),
                *((none, pa.array(rows[:, n])) for n in range(len(TABLE))),
            ]
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(parts) for parts in columns], ["a", "b", "slot", *TABLE]
            )

        def finish(lo, hi):
            if hi - lo > limit or large and lo == 0:
                return [], [(marks[lo:hi], slots[lo:hi], table[lo:hi])]
            return (group_links(marks[lo:hi], table[lo:hi], max_bits) if hi - lo > 1 else []), []

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            slots, keys, marks = (
                np.concatenate((old, n)) for old, n in zip((slots, keys, marks), new[:3], strict=True)
            )
            table = np.concatenate((table, np.stack(new[3:], axis=1)))
            if not len(marks):
                continue
            change = np.flatnonzero((np.diff(slots) != 0) | (np.diff(keys) != 0)) + 1
            edges = np.concatenate(([0], change))
            sizes = np.diff(edges)
            links, members = [], []
            for place in np.flatnonzero((sizes > 1) | ((edges[:-1] == 0) & large)):
                found = finish(edges[place], edges[place + 1])
                links += found[0]
                members += found[1]
            tail = edges[-1]
            large = large and tail == 0
            slots, keys, marks, table = slots[tail:], keys[tail:], marks[tail:], table[tail:]
            if len(marks) > limit or large:
                # The run goes on; its members leave now, but one that marks the place.
                large = True
                members.append((marks[:-1], slots[:-1], table[:-1]))
                slots, keys, marks, table = slots[-1:], keys[-1:], marks[-1:], table[-1:]
            yield result(links, members)
        if len(marks):
            yield result(*finish(0, len(marks)))

    return work


def close_links(marks: DataFrame, max_bits: int = 3, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) under which distinct fingerprints hang together as by all close pairs.

    ``marks`` has one column ``fingerprint`` without repeats. Their pivot table is made
    once and goes with them into their groups, where it discards pairs. No more than one
    link leaves a group for each of its members, however close they all are.
    """
    coarse = key_masks(max_bits)

    def dealt(rows: DataFrame, masks) -> DataFrame:
        keyed = rows.select("fingerprint", *TABLE, F.explode(masks).alias("m"))
        return (
            keyed.select(
                F.col("m.slot").cast("long").alias("slot"),
                F.col("fingerprint").bitwiseAND(F.col("m.mask")).alias("key"),
                "fingerprint",
                *TABLE,
            )
            .repartition("slot", "key")
            .sortWithinPartitions("slot", "key", "fingerprint")
        )

    def listed(masks: list[int], base: int = 0):
        return F.array(
            *[
                F.struct(F.lit(base + n).alias("slot"), F.lit(signed(m)).cast("long").alias("mask"))
                for n, m in enumerate(masks)
            ]
        )

    schema = ", ".join([LINKS, "slot long", *(f"{name} long" for name in TABLE)])
    first = stored(
        dealt(with_distances(marks), listed(coarse)).mapInArrow(_runs(max_bits, group_rows), schema), "links"
    )
    links = first.filter("b IS NOT NULL").select("a", "b")
    large = first.filter("b IS NULL").select(F.col("a").alias("fingerprint"), "slot", *TABLE)
    # One row for each coarse mask: 20 for three bits.
    spark = marks.sparkSession
    finer = spark.createDataFrame(
        [
            (
                slot,
                [
                    (1000 * (slot + 1) + n, signed(part))
                    for n, part in enumerate(fine_masks(mask, max_bits))
                ],
            )
            for slot, mask in enumerate(coarse)
        ],
        "slot long, masks array<struct<slot: long, mask: long>>",
    )
    fine = large.distinct().join(F.broadcast(finer), "slot").select("fingerprint", *TABLE, "masks")
    again = dealt(fine, F.col("masks")).mapInArrow(_runs(max_bits, 1 << BITS - 1), schema)
    return links.unionByName(again.select("a", "b"))


def clusters(marked: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fingerprint, root, component_id) for each distinct fingerprint of ``marked``.

    ``root`` is the smallest fingerprint reachable over links of up to ``max_bits``
    differing bits; ``component_id`` the smallest id among all documents there, null
    if none has an id.
    """
    distinct = stored(marked.groupBy("fingerprint").agg(F.min("id").alias("low")), "marks")
    found = components(close_links(distinct.select("fingerprint"), max_bits))
    rooted = distinct.join(
        found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return stored(
        rooted.join(lowest, "root").select("fingerprint", "root", "component_id"), "clusters"
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """(id, fingerprint in hexadecimal, component_id) of every document.

    Documents whose fingerprints differ in up to ``max_bits`` bits are linked;
    ``component_id`` is the smallest id reachable. Empty, blank and null texts all
    have fingerprint 0. Rows with a repeated id each keep their row; rows without an
    id belong to the component of their fingerprint and never name it, so a
    component where no row has an id has none. An empty table gives no rows.
    """
    marked = stored(fingerprints(docs, id_column, text_column, shingle_words), "fingerprints")
    return (
        marked.join(clusters(marked, max_bits), "fingerprint")
        .withColumn("hex", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
        .select(
            F.col("id").alias(id_column), F.col("hex").alias("fingerprint"), "component_id"
        )
    )


def one_per_group(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """One whole document of each group of near-duplicates: that with the smallest id.

    Among rows of that id the one with the smallest row hash stays, and of rows
    equal in every column one. The columns are those of ``docs``.
    """
    marked = stored(fingerprints(docs, id_column, text_column, shingle_words), "fingerprints")
    keeper = F.struct(F.col("id").isNull(), "id", "row_hash")
    kept = (
        marked.join(clusters(marked, max_bits), "fingerprint")
        .groupBy("root")
        .agg(F.min(keeper).alias("kept"))
        .select("kept.row_hash")
        .distinct()
    )
    name = fresh(docs, "row_hash")
    # Each task keeps one of equal rows first, so that many copies never meet. The
    # join has dealt the rows by the key that the last step groups them by.
    chosen = once_per_task(docs.withColumn(name, identity(docs)[0]), name).join(
        kept.withColumnRenamed("row_hash", name), name, "left_semi"
    )
    return chosen.dropDuplicates([name]).drop(name)


def once_per_task(df: DataFrame, key: str) -> DataFrame:
    """``df`` without rows whose ``key`` an earlier row of the same partition has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(place).to_pylist()
            new = [k not in seen and not seen.add(k) for k in keys]
            yield batch.filter(pa.array(new, pa.bool_()))

    place = df.columns.index(key)
    plain = numbered(df)
    return plain.mapInArrow(work, plain.schema).toDF(*df.columns)
