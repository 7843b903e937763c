"""Documents packed into sequences of bounded tokens, documents and attention cost.

Best fit over vectors. A piece asks for its tokens, for one document, and for the square of
its tokens, the cost of attention inside it. It goes to a sequence that can still hold it by
every capacity: to the one where least is left afterwards (the weighted squared norm of the
residual capacities), or where the piece and the residual capacities have the least weighted
dot product, so that room is kept where a piece asks little. Longest pieces come first.

Pieces are dealt at random, ids and all, to groups of a bounded size, and one task packs a
group. A sequence with more than LOOSE of its tokens free is taken apart, and the pieces of
all such sequences are dealt and packed again; what the last round leaves stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import column, slices, stored
from farebox.llm.tokens import tokenizer

END_ID = 1
# A group is made for each so many documents or bytes of text, whichever are more.
GROUP = 4096
GROUP_BYTES = 24 << 20
TASK_GROUPS = 8
# The free share of a sequence's tokens from which on its pieces are packed again.
LOOSE = 0.02
ROUNDS = 3
ENCODED = 3 << 20
# Sequences whose ids are widened at once.
WIDENED = 1024


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds, and what the dimensions weigh when one is chosen."""

    tokens: int = 4096
    documents: int = 4096
    cost: int = 4096**2
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost], np.float64)

    def longest(self) -> int:
        """The tokens of the longest piece that a sequence can hold."""
        return min(self.tokens, math.isqrt(self.cost))


# ---- Best fit -------------------------------------------------------------------------


def best_fit(
    lengths: np.ndarray, capacities: Capacities, rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """For pieces in descending order of length: the sequence of each, and its place there.

    ``rule`` is "norm" or "dot". Of equally good sequences the oldest is taken.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule: {rule}")
    limits, weights = capacities.limits(), capacities.weights
    # Whole numbers below 2**53 are exact in a double: what fits is decided by the numbers.
    lengths = np.asarray(lengths, np.float64)
    asked = np.stack([lengths, np.ones(len(lengths)), lengths**2])
    # No later piece asks less than the last: fuller sequences are not looked at again.
    least = asked[:, -1] if len(lengths) else limits
    free, names = np.zeros((3, len(lengths))), np.zeros(len(lengths), np.int64)
    chosen, places = np.zeros((2, len(lengths)), np.int64)
    opened = live = 0
    for n, piece in enumerate(asked.T):
        tokens, documents, cost = free[:, :live]
        fits = np.flatnonzero((tokens >= piece[0]) & (documents >= piece[1]) & (cost >= piece[2]))
        if len(fits):
            room = free[:, fits]
            score = np.zeros(len(fits))
            for dimension in range(3):
                share = room[dimension] / limits[dimension]
                mine = piece[dimension] / limits[dimension]
                if rule == "norm":
                    score += weights[dimension] * (share - mine) ** 2
                else:
                    score += weights[dimension] * mine * share
            at = fits[np.argmin(score)]
        else:
            at, live = live, live + 1
            free[:, at], names[at] = limits, opened
            opened += 1
        chosen[n], places[n] = names[at], capacities.tokens - free[0, at]
        free[:, at] -= piece
        if (free[:, at] < least).any():
            # The rest move up and keep their order.
            free[:, at : live - 1] = free[:, at + 1 : live]
            names[at : live - 1] = names[at + 1 : live]
            live -= 1
    return chosen, places


_PARTS = "offset:bigint,length:bigint,doc_id:bigint,piece:int,start:bigint"
_NAMES = [field.split(":")[0] for field in _PARTS.split(",")]
_PACKED = f"sequence_id long, loose boolean, ids binary, parts array<struct<{_PARTS}>>"


def _packed_group(capacities: Capacities, rule: str):
    def pack(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        # Ties in a fixed order, so that a task that runs again packs alike.
        order = np.lexsort(
            (group.column("piece").to_numpy(), group.column("row").to_numpy(), -lengths)
        )
        lengths = lengths[order]
        chosen, places = best_fit(lengths, capacities, rule)
        used = np.bincount(chosen, lengths, chosen.max(initial=-1) + 1)
        loose = capacities.tokens - used > LOOSE * capacities.tokens
        within = np.lexsort((places, chosen))
        parts = group.take(pa.array(order[within]))
        kept = [pa.array(places[within], pa.int64())]
        kept += [parts.column(name).combine_chunks() for name in _NAMES[1:]]
        cuts = np.concatenate(([0], np.cumsum(np.bincount(chosen, minlength=len(used)))))
        ids = b"".join(parts.column("ids").to_pylist())
        width = len(ids) // max(1, int(lengths.sum()))
        ends = np.concatenate(([0], np.cumsum(used))).astype(np.int64) * width
        first = group.column("group")[0].as_py() << 20
        return pa.table(
            {
                "sequence_id": pa.array(first + np.arange(len(used)), pa.int64()),
                "loose": pa.array(loose, pa.bool_()),
                "ids": _runs(ids, ends),
                "parts": pa.ListArray.from_arrays(
                    cuts.astype(np.int32), pa.StructArray.from_arrays(kept, _NAMES)
                ),
            }
        )

    return pack


def _runs(data: bytes, ends: np.ndarray) -> pa.Array:
    """The runs of some bytes between the given places."""
    places = pa.py_buffer(ends.astype(np.int32))
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, places, pa.py_buffer(data)]
    )


def _taken_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of some sequences, with rows made of their sequences and places there."""
    for batch in batches:
        rows = []
        for sequence in batch.to_pylist():
            width = len(sequence["ids"]) // sum(part["length"] for part in sequence["parts"])
            for part in sequence["parts"]:
                lo = part["offset"] * width
                ids = sequence["ids"][lo : lo + part["length"] * width]
                name = (sequence["sequence_id"] * 4099 + part["offset"]) % (1 << 62)
                rows.append({"row": name, **{n: part[n] for n in _NAMES[1:]}, "ids": ids})
        kinds = pa.schema(
            [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32())]
            + [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
        )
        yield pa.RecordBatch.from_pylist(rows, kinds)


def packed(
    pieces: DataFrame, groups: int, capacities: Capacities, rule: str = "norm"
) -> DataFrame:
    """(sequence_id, ids, parts) for ``pieces`` (row, doc_id, piece, start, length, ids).

    Row and piece only deal the pieces out, best if no two have the same. None may be longer
    than a sequence holds. Parts are in their order, and ``ids`` are as wide as the pieces'.
    """
    found = []
    for number in range(ROUNDS):
        # Each round deals anew, and in numbers of sequences no other round uses.
        dealt = F.pmod(F.xxhash64("row", "piece", F.lit(number)), F.lit(groups))
        # Groups of few bytes still go to as many tasks as the cluster's shuffles have, and no
        # task gets more than a few groups.
        usual = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(min(groups, usual), math.ceil(groups / TASK_GROUPS))
        made = stored(
            pieces.withColumn("group", dealt + F.lit(number << 32))
            .repartition(tasks, "group")
            .groupBy("group")
            .applyInArrow(_packed_group(capacities, rule), _PACKED),
            "packed",
        )
        if groups == 1 or number == ROUNDS - 1:
            found.append(made)
            break
        found.append(made.filter(~F.col("loose")))
        loose = made.filter("loose")
        count, tokens = loose.agg(
            F.sum(F.size("parts")), F.sum(F.octet_length("ids"))
        ).first()
        if count is None:
            break
        groups = max(math.ceil(count / GROUP), math.ceil(tokens / GROUP_BYTES))
        pieces = loose.mapInArrow(_taken_apart, _PIECES)
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole.drop("loose")


# ---- Documents ------------------------------------------------------------------------

_PIECES = "row long, doc_id long, piece int, start long, length long, ids binary"


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    longest: int,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(row, doc_id, piece, start, length, ids) of every document, cut where it is too long.

    ``ids`` are those of the text and ``end_id``, as little-endian unsigned integers of 16
    bits where the vocabulary has no greater ones, else of 32. ``row`` tells documents apart,
    whatever their ids; it is not the same in every run.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        column(docs, id_column).cast("long").alias("doc_id"),
        column(docs, text_column).cast("string").alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(tokenizer_path)
        kind = np.dtype("<u2" if max(len(coder.last) - 1, end_id) < 1 << 16 else "<u4")
        for batch in slices(batches, "text", ENCODED):
            ids, cuts = coder.encode(batch.column("text"))
            # The encoder marks the end of each text by an id of its own.
            ids[cuts[1:] - 1] = end_id
            sizes = np.diff(cuts)
            parts = -(-sizes // longest)
            owner = np.repeat(np.arange(len(sizes)), parts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * longest
            length = np.minimum(sizes[owner] - start, longest)
            # The pieces lie one after another.
            ends = np.concatenate(([0], np.cumsum(length))) * kind.itemsize
            values = _runs(ids.astype(kind).tobytes(), ends)
            chosen = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(chosen),
                    batch.column("doc_id").take(chosen),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    values,
                ],
                [field.split()[0] for field in _PIECES.split(", ")],
            )
        # The process stays for other tasks, of other operators too.
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(encode, _PIECES)


def sequences(
    docs: DataFrame,
    tokenizer_path: str,
    capacities: Capacities | None = None,
    rule: str = "norm",
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(sequence_id, ids, parts): the documents packed into sequences.

    ``ids`` are a sequence's tokens as little-endian unsigned 32-bit integers, and ``parts``
    says which piece of which document is where: (offset, length, doc_id, piece, start).
    Documents are cut only where they are longer than a sequence holds.

    A null text is an empty one, whose only id is ``end_id``. Rows without an id, with equal
    ids, or equal altogether are documents of their own. An empty table gives no sequence.
    A text of any length is tokenized whole, by one task, and leaves it in pieces. Further
    columns are not looked at.
    """
    capacities = capacities or Capacities()
    count, size = docs.agg(
        F.count(F.lit(1)), F.sum(F.octet_length(column(docs, text_column).cast("string")))
    ).first()
    groups = max(1, math.ceil(count / GROUP), math.ceil((size or 0) / GROUP_BYTES))
    cut = pieces(docs, tokenizer_path, capacities.longest(), end_id, id_column, text_column)
    return packed(cut, groups, capacities, rule).mapInArrow(
        _widened, f"sequence_id long, ids binary, parts array<struct<{_PARTS}>>"
    )


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences with ids of 32 bits."""
    for whole in batches:
        for lo in range(0, whole.num_rows, WIDENED):
            batch = whole.slice(lo, WIDENED)
            parts = batch.column("parts")
            lengths = parts.flatten().field("length").to_numpy()
            cuts = parts.offsets.to_numpy().astype(np.int64)
            bounds = np.concatenate(([0], np.cumsum(lengths)))[cuts - cuts[0]]
            data = b"".join(batch.column("ids").to_pylist())
            ids = np.frombuffer(data, "<u4" if len(data) > 2 * bounds[-1] else "<u2")
            wide = _runs(ids.astype("<u4").tobytes(), bounds * 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), wide, parts], ["sequence_id", "ids", "parts"]
            )
