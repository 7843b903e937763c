"""Passages that repeat across documents, found with a sparse suffix array."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import column, mixed, slices, split_words, stored, window_hashes

# A repeated passage has at least this many words.
MIN_WORDS = 50
# Suffixes are kept at the minimisers of GRAM words among SPREAD neighbouring places: a
# passage of GRAM + SPREAD - 1 words has one, at the same word in every copy. It lies at
# most SPREAD - 1 words from the passage's start, and HEAD words of the passage follow it.
GRAM = 5
SPREAD = 30
HEAD = MIN_WORDS - SPREAD + 1
# Words on either side of the head that a row carries for the extension, two bytes each.
LEFT, RIGHT = SPREAD - 1, MIN_WORDS - HEAD

ROWS = "key long, after binary, before binary, id long, mark long, pos int, length int"
COLUMNS = [field.split()[0] for field in ROWS.split(", ")]
SPANS = "id long, mark long, first int, last int, other_id long"
# Rows of whole heads that are compared at once.
COMPARED = 1 << 17


def minimisers(grams: np.ndarray, spread: int) -> np.ndarray:
    """Places that hold the smallest hash among ``spread`` neighbours, the leftmost of equal ones."""
    count = len(grams) - spread + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    # Smallest (hash, place) over windows of doubling width.
    best = np.arange(len(grams))
    width = 1
    while width < spread:
        step = min(width, spread - width)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        width += step
    return np.unique(best)


def _places(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Word hashes, where texts begin, head hashes, and the suffixes kept with their texts."""
    words, bounds = split_words(batch.column("text"))
    names = np.asarray(words.dictionary.to_pylist(), dtype=object)
    tokens = np.zeros(0, np.uint64)
    if len(names):
        tokens = pd.util.hash_array(names, categorize=False)[words.indices.to_numpy()]
    grams = window_hashes(tokens, GRAM)
    places = [np.zeros(0, np.int64)]
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= MIN_WORDS:
            places.append(lo + minimisers(grams[lo : hi - GRAM + 1], SPREAD))
    place = np.concatenate(places)
    whose = np.searchsorted(bounds, place, side="right") - 1
    fits = place + HEAD <= bounds[whose + 1]
    return tokens, bounds, window_hashes(tokens, HEAD), place[fits], whose[fits]


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of every suffix."""
    for batch in slices(batches, "text"):
        _, _, heads, place, _ = _places(batch)
        yield pa.RecordBatch.from_arrays([pa.array(heads[place].view(np.int64))], ["key"])


def _suffixes(keys: np.ndarray, chosen: bool):
    """Rows of the suffixes whose head is among ``keys``, or of all others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tokens, bounds, heads, place, whose = _places(batch)
            wanted = np.isin(heads[place].view(np.int64), keys, invert=not chosen)
            yield _rows(batch, tokens, bounds, heads, place[wanted], whose[wanted])

    return work


def _rows(batch, tokens, bounds, heads, place, whose) -> pa.RecordBatch:
    short = np.concatenate(
        (np.zeros(LEFT, np.uint16), (mixed(tokens) >> np.uint64(48)).astype(np.uint16),
         np.zeros(HEAD + RIGHT, np.uint16))
    )
    windows = np.lib.stride_tricks.sliding_window_view
    # Big-endian, so that bytes sort as the words' numbers do.
    right = windows(short, RIGHT)[place + LEFT + HEAD].astype(">u2")
    left = windows(short, LEFT)[place][:, ::-1].astype(">u2")
    return pa.RecordBatch.from_arrays(
        [
            pa.array(heads[place].view(np.int64)),
            _fixed(right),
            _fixed(left),
            batch.column("id").take(pa.array(whose)),
            batch.column("mark").take(pa.array(whose)),
            pa.array((place - bounds[whose]).astype(np.int32)),
            pa.array((bounds[whose + 1] - bounds[whose]).astype(np.int32)),
        ],
        COLUMNS,
    )


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    data = np.ascontiguousarray(rows)
    width = data.shape[1] * data.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )


def _matrix(values: pa.Array, words: int) -> np.ndarray:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset :][: len(values) + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(np.uint16).reshape(-1, words)


def _prefixes(rows: np.ndarray) -> np.ndarray:
    """A hash of each row's first 0, 1, 2, … words."""
    out = np.zeros((rows.shape[1] + 1, len(rows)), np.uint64)
    for n in range(rows.shape[1]):
        out[n + 1] = mixed((out[n] ^ rows[:, n].astype(np.uint64)) + np.uint64(n + 1))
    return out


def _compared(rows: pa.Table) -> pa.RecordBatch:
    """What each suffix shares with suffixes of other documents, of whole heads in order.

    The words that sorted neighbours share cut the order into runs: those between two
    suffixes are the least of those on the way from one to the other. So for each number of
    words shared to the right, a run and the words to the left that are missing up to
    MIN_WORDS name all suffixes that share such a passage, however many lie between them.
    """
    key, ids, marks, pos, length = (
        rows.column(c).to_numpy() for c in ("key", "id", "mark", "pos", "length")
    )
    after, before = _matrix(rows.column("after"), RIGHT), _matrix(rows.column("before"), LEFT)
    begins = np.concatenate(([True], key[1:] != key[:-1]))
    head = np.cumsum(begins) - 1
    starts = np.flatnonzero(begins)
    # Heads of one document have nothing to share.
    met = (np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts))[head]
    key, ids, marks, pos, length, after, before, head = (
        values[met] for values in (key, ids, marks, pos, length, after, before, head)
    )
    differ = after[1:] != after[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), RIGHT)
    shared = np.where(head[1:] != head[:-1], -1, shared)
    lefts = _prefixes(before)
    room = length - pos - HEAD
    fewest, most = np.full(len(key), LEFT + 1), np.full(len(key), -1)
    low = np.full(len(key), np.iinfo(np.int64).max)
    high = np.full(len(key), np.iinfo(np.int64).min)
    for left in range(LEFT + 1):
        right = MIN_WORDS - HEAD - left
        run = np.concatenate((np.zeros(min(1, len(key)), int), np.cumsum(shared < right)))
        able = np.flatnonzero((pos >= left) & (room >= right))
        if not len(able):
            continue
        name = mixed(lefts[left][able] ^ mixed(run[able].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(name, kind="stable")
        able, name = able[order], name[order]
        edges = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        least = np.minimum.reduceat(ids[able], edges)
        greatest = np.maximum.reduceat(ids[able], edges)
        group = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(able))))
        good = (least < greatest)[group]
        able, group = able[good], group[good]
        fewest[able] = np.minimum(fewest[able], left)
        most[able] = np.maximum(most[able], left)
        low[able] = np.minimum(low[able], least[group])
        high[able] = np.maximum(high[able], greatest[group])
    found = np.flatnonzero(most >= 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[found]),
            pa.array(marks[found]),
            # All these passages hold the head, so they are one.
            pa.array((pos - most)[found].astype(np.int32)),
            pa.array((pos - fewest + MIN_WORDS)[found].astype(np.int32)),
            pa.array(np.where(low == ids, high, low)[found]),
        ],
        [field.split()[0] for field in SPANS.split(", ")],
    )


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_compared`` of rows sorted by key, as many whole keys at a time as COMPARED rows are."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < COMPARED:
            continue
        rows = pa.Table.from_batches(held)
        keys = rows.column("key").to_numpy()
        # The last key may go on.
        whole = int(np.flatnonzero(keys != keys[-1])[-1:].sum()) + 1 if keys[0] != keys[-1] else 0
        if whole:
            yield _compared(rows.slice(0, whole))
        held = rows.slice(whole).combine_chunks().to_batches()
        count = rows.num_rows - whole if whole else 0
    if held:
        yield _compared(pa.Table.from_batches(held))


def _frequent_spans(rows: DataFrame) -> DataFrame:
    """The same for heads too frequent to be held by one task.

    Rows that have the same words around them, as most of a frequent head have, become one
    context. Each context names the passages of MIN_WORDS words around its head, by its
    words to the right and to the left; those of several documents are what is shared.

    Both joins sort: Spark would take the few bytes that alike rows have in a file, which it
    does not even multiply by the passages of each, for their size, and send them all through
    the driver.
    """
    context = ["key", "after", "before", "left", "right"]
    around = rows.withColumns(
        {
            "left": F.least("pos", F.lit(LEFT)),
            "right": F.least(F.col("length") - F.col("pos") - HEAD, F.lit(RIGHT)),
        }
    )
    contexts = stored(
        around.groupBy(*context).agg(F.min("id").alias("low"), F.max("id").alias("high")),
        "contexts",
    )
    fewest, words = F.lit(RIGHT) - F.col("right"), F.col("k")
    sides = (
        F.substring("after", F.lit(1), 2 * (RIGHT - words)),
        F.substring("before", F.lit(1), 2 * words),
    )
    passages = (
        contexts.filter(fewest <= F.col("left"))
        .withColumn("k", F.explode(F.sequence(fewest, "left")))
        .withColumns(
            {
                "one": F.xxhash64("key", "k", *sides),
                "two": F.xxhash64(F.lit(1), *sides, "k", "key"),
            }
        )
    )
    shared = (
        passages.groupBy("one", "two")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .filter(F.col("low") < F.col("high"))
    )
    found = (
        passages.drop("low", "high")
        .join(shared.hint("merge"), ["one", "two"])
        .groupBy(*context)
        .agg(
            F.min("k").alias("fewest"),
            F.max("k").alias("most"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
    )
    return around.join(found.hint("merge"), context).select(
        "id",
        "mark",
        (F.col("pos") - F.col("most")).cast("int").alias("first"),
        (F.col("pos") - F.col("fewest") + MIN_WORDS).cast("int").alias("last"),
        F.when(F.col("low") == F.col("id"), F.col("high")).otherwise(F.col("low")).alias("other_id"),
    )


def repeated_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tasks: int | None = None,
) -> DataFrame:
    """(id, first, last, n_words, other_id): passages that another document has as well.

    A word is a run of characters other than space and the controls 9 to 13; ``first``
    and ``last`` count words, the end exclusive. A passage has at least 50 words, all of
    which another document has in a row; passages that overlap or touch are one. ``other_id``
    is an id it was found in, the smallest of those its suffixes name. Suffixes at minimisers
    are sorted by what follows them, neighbours compared, and matches extended to both sides:
    every passage is found, whatever else shares its head. Words beside the head are compared
    by 16 bits, so that a passage may be a word too long, with a chance of 1 in 65,536.

    A head with more than one in ``tasks`` of all suffixes (default: one in the session's
    shuffle partitions) is compared by many tasks, any other by one; the result is the same.
    Rows with one id are one document, and rows without an id another; rows of one document
    that differ have passages, and places, of their own. Null and short texts have no passage,
    an empty table none at all. A text of any length is held whole, with some 60 bytes for
    each of its words.
    """
    rows = docs.select(
        column(docs, id_column).cast("long").alias("id"),
        column(docs, text_column).cast("string").alias("text"),
    )
    # A number for rows without an id, put back below; ids are not that small.
    none = -(1 << 63)
    numbered = rows.withColumn("id", F.coalesce("id", F.lit(none))).withColumn(
        "mark", F.xxhash64("text")
    )
    hot = _frequent_heads(
        numbered, tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    )
    dealt = numbered.mapInArrow(_suffixes(hot, chosen=False), ROWS).repartition("key")
    spans = [dealt.sortWithinPartitions("key", "after").mapInArrow(_spans, SPANS)]
    if len(hot):
        frequent = stored(numbered.mapInArrow(_suffixes(hot, chosen=True), ROWS), "heads")
        spans.append(_frequent_spans(frequent))
    return _merged(reduce(DataFrame.unionByName, spans)).select(
        F.nullif("id", F.lit(none)).alias(id_column),
        "first",
        "last",
        (F.col("last") - F.col("first")).alias("n_words"),
        F.nullif("other_id", F.lit(none)).alias("other_id"),
    )


def _frequent_heads(numbered: DataFrame, tasks: int) -> np.ndarray:
    """The heads, fewer than ``tasks``, that have more than one in ``tasks`` of all suffixes."""
    heads = numbered.mapInArrow(_heads, "key long")
    sizes = heads.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    share = sizes.agg(F.sum("n") / tasks).scalar()
    found = sizes.filter(F.col("n") > share).select("key").toArrow()
    return found.column("key").to_numpy()


def _merged(spans: DataFrame) -> DataFrame:
    """The union of the spans of each text as separate passages.

    Spans are first reduced to the longest from each start, so that a document that
    many others repeat has no more rows than it has words.
    """
    reduced = spans.groupBy("id", "mark", "first").agg(
        F.max("last").alias("last"), F.min("other_id").alias("other_id")
    )
    order = Window.partitionBy("id", "mark").orderBy("first")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opened = reduced.withColumn(
        "opens", F.coalesce(F.col("first") > F.max("last").over(before), F.lit(True))
    )
    passage = F.sum(F.col("opens").cast("int")).over(order)
    return (
        opened.withColumn("passage", passage)
        .groupBy("id", "mark", "passage")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.min("other_id").alias("other_id"),
        )
    )
