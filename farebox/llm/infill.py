"""Fill-in-the-middle rows from whole texts, cut by a learned rank index.

A text's tokens are words with the white space before them, and white space at its end.
The index of a text maps the rank of a token boundary to its place: line segments, fitted
to all boundaries so that no place is farther than ERROR bytes from its line, predict it,
and the stored residual of the rank corrects it exactly. A cut costs one search among the
segments, and the index about a byte for each token, a tenth of the boundaries themselves.
Stored beside the texts, it serves further rounds of cuts without reading words again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from farebox.llm.common import column, slices

# The markers of a row's parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# A line may miss a boundary by this many bytes, which a residual of 8 bits holds.
ERROR = 127
# Bytes of a text whose words are looked for at once.
SCANNED = 1 << 22
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


# ---- The index ------------------------------------------------------------------------


def boundaries(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token boundaries of some texts, and where each text's begin (one entry more).

    ``data`` is the texts' bytes one after another, ``cuts`` where each begins. A text has
    a boundary at its start and one after each token, as places in the text.
    """
    lengths = np.diff(cuts)
    last = cuts[1:][lengths > 0] - 1
    ends = [np.zeros(0, np.int64)]
    for lo in range(0, len(data), SCANNED):
        hi = min(lo + SCANNED, len(data))
        space = SPACES[data[lo : hi + 1]]
        final = np.zeros(hi - lo, bool)
        final[: len(space) - 1] = ~space[: len(space) - 1] & space[1:]
        mine = last[np.searchsorted(last, lo) : np.searchsorted(last, hi)]
        # The next text's first byte says nothing; white space at the end is a token.
        final[mine - lo] = True
        ends.append(np.flatnonzero(final) + (lo + 1))
    ends = np.concatenate(ends)
    before = np.searchsorted(ends, cuts, side="right")
    before[-1] = len(ends)
    starts = before + np.arange(len(cuts))
    counts = np.diff(before)
    places = np.zeros(len(ends) + len(lengths), np.int64)
    inner = np.ones(len(places), bool)
    inner[starts[:-1]] = False
    places[inner] = ends - np.repeat(cuts[:-1], counts)
    return places, starts


class RankIndex:
    """Line segments and residuals over the boundaries of some texts.

    Ranks count on from text to text: that of a boundary is its text's entry in ``starts``
    and its number in the text.
    """

    def __init__(
        self, starts: np.ndarray, firsts: np.ndarray, lines: np.ndarray, residuals: np.ndarray
    ):
        self.starts, self.firsts, self.lines, self.residuals = starts, firsts, lines, residuals

    @classmethod
    def fitted(cls, places: np.ndarray, starts: np.ndarray) -> RankIndex:
        """Fit lines through a segment's first and last boundary, halving it until they do."""
        residuals = np.zeros(len(places), np.int8)
        low, high = starts[:-1], starts[1:]
        kept_first, kept_lines = [], []
        while len(low):
            sizes = high - low
            lines = np.stack([places[low], places[high - 1] - places[low], np.maximum(sizes - 1, 1)])
            begins = np.cumsum(sizes) - sizes
            number = np.repeat(np.arange(len(low)), sizes)
            into = np.arange(len(number)) - begins[number]
            rank = low[number] + into
            missed = places[rank] - predicted(lines[:, number], into)
            fits = np.maximum.reduceat(np.abs(missed), begins) <= ERROR
            good = fits[number]
            residuals[rank[good]] = missed[good]
            kept_first.append(low[fits])
            kept_lines.append(lines[:, fits])
            low, high = low[~fits], high[~fits]
            half = (low + high) // 2
            low, high = np.concatenate((low, half)), np.concatenate((half, high))
        firsts = np.concatenate([np.zeros(0, np.int64), *kept_first])
        lines = np.concatenate([np.zeros((3, 0), np.int64), *kept_lines], axis=1)
        order = np.argsort(firsts)
        return cls(starts, firsts[order], lines[:, order], residuals)

    def places(self, ranks: np.ndarray) -> np.ndarray:
        """The exact places of boundaries: the line's, corrected by the residual."""
        segment = np.searchsorted(self.firsts, ranks, side="right") - 1
        guess = predicted(self.lines[:, segment], ranks - self.firsts[segment])
        return guess + self.residuals[ranks]

    def stored(self) -> list[bytes]:
        """The index of each text in little-endian bytes: the number of segments, then their
        first ranks, places, rises and runs, then a residual for each boundary."""
        own = np.searchsorted(self.firsts, self.starts)
        found = []
        for n in range(len(self.starts) - 1):
            mine, ranks = slice(own[n], own[n + 1]), slice(self.starts[n], self.starts[n + 1])
            head = np.array([own[n + 1] - own[n]])
            parts = (head, self.firsts[mine] - self.starts[n], *self.lines[:, mine])
            found.append(
                b"".join(part.astype("<i8").tobytes() for part in parts)
                + self.residuals[ranks].tobytes()
            )
        return found

    @classmethod
    def loaded(cls, parts: list[bytes]) -> RankIndex:
        """The inverse of ``stored``."""
        firsts, lines, residuals, starts = [], [], [], [0]
        for part in parts:
            count = int(np.frombuffer(part, "<i8", 1)[0])
            table = np.frombuffer(part, "<i8", 4 * count, 8).reshape(4, count)
            errors = np.frombuffer(part, np.int8, offset=8 + 32 * count)
            firsts.append(table[0] + starts[-1])
            lines.append(table[1:])
            residuals.append(errors)
            starts.append(starts[-1] + len(errors))
        if not parts:
            empty = np.zeros(0, np.int64)
            return cls(np.zeros(1, np.int64), empty, np.zeros((3, 0), np.int64), empty)
        return cls(
            np.array(starts),
            np.concatenate(firsts),
            np.concatenate(lines, axis=1),
            np.concatenate(residuals),
        )


def predicted(lines: np.ndarray, into: np.ndarray) -> np.ndarray:
    """What lines (place, rise, run) give so many ranks after their first."""
    place, rise, run = lines
    return place + into * rise // run


def _texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts, null being empty, and where each begins (one entry more)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    cuts = np.frombuffer(texts.buffers()[1], np.int64)
    cuts = cuts[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    return data[cuts[0] : cuts[-1]], cuts - cuts[0]


def with_index(docs: DataFrame, name: str, text_column: str = "text") -> DataFrame:
    """``docs`` with the rank index of each text in a further binary column, to be stored."""
    schema = StructType([*docs.schema.fields, StructField(name, BinaryType())])
    names = schema.names

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            built = RankIndex.fitted(*boundaries(*_texts(batch.column(text_column))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(built.stored(), pa.binary())], names
            )

    return docs.mapInArrow(index, schema)


# ---- Rows -----------------------------------------------------------------------------

CUT = "id long, n long, form string, prefix_chars long, middle_chars long, output string"


def transformed(
    docs: DataFrame,
    seed: int = 42,
    rate: int = 50,
    spm_rate: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
    index_column: str | None = None,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every document.

    Two hashes of the seed and the id choose two of a text's ``n`` + 1 token boundaries,
    which part prefix, middle and suffix; two more choose the form: ``rate`` of 100 texts
    are rearranged, and ``spm_rate`` of 100 of these begin with the suffix. All others, texts
    with a marker of their own among them, stay plain, with null lengths. Boundaries come
    from the rank index: the one stored in ``index_column``, or one built here.

    A null text is an empty one, and an empty text is plain. A null id hashes like an empty
    string. Rows that are equal, or share an id, each give a row, with equal choices for
    equal ids. An empty table gives none. One text is held whole, with a place of 8 bytes
    for each of its tokens while its index is built; nothing else grows with it.
    """
    picked = {
        "id": column(docs, id_column).cast("long"),
        "text": column(docs, text_column).cast("string"),
    }
    if index_column is not None:
        picked["index"] = column(docs, index_column)
    rows = docs.select(*[value.alias(name) for name, value in picked.items()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, cuts = _texts(batch.column("text"))
            if index_column is None:
                index = RankIndex.fitted(*boundaries(data, cuts))
            else:
                index = RankIndex.loaded(batch.column("index").to_pylist())
            ids = batch.column("id").to_pylist()
            keys = [f"{seed}:{'' if n is None else n}".encode() for n in ids]
            heads = b"".join(hashlib.sha256(key).digest()[:16] for key in keys)
            chosen = np.frombuffer(heads, ">u4").reshape(-1, 4).astype(np.int64)
            tokens = np.diff(index.starts) - 1
            ranks = np.sort(chosen[:, :2] % (tokens + 1)[:, None], axis=1)
            at = index.places(ranks + index.starts[:-1, None])
            out = [
                _row(data[lo:hi].tobytes(), first, second, h3 % 100 < rate, h4 % 100 < spm_rate)
                for lo, hi, (first, second), (_, _, h3, h4) in zip(
                    cuts[:-1].tolist(), cuts[1:].tolist(), at.tolist(), chosen.tolist(), strict=True
                )
            ]
            form, prefix, middle, output = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(tokens, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                [field.split()[0] for field in CUT.split(", ")],
            )

    return rows.mapInArrow(cut, CUT)


_MARKERS = [marker.encode() for marker in (PREFIX, SUFFIX, MIDDLE)]


def _row(
    text: bytes, first: int, second: int, rearranged: bool, spm: bool
) -> tuple[str, int | None, int | None, bytes]:
    if not text or not rearranged or any(marker in text for marker in _MARKERS):
        return "plain", None, None, text
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = _MARKERS
    parts = [s, suffix, p, prefix] if spm else [p, prefix, s, suffix]
    lengths = len(prefix.decode()), len(middle.decode())
    return ("spm" if spm else "psm"), *lengths, b"".join([*parts, m, middle])


def restored(output: Column, form: Column) -> Column:
    """The text that a row was made from.

    The first marker begins the row, and the first occurrence of each later one is where
    its part begins, as no marker is in a text or half in one.
    """

    def parts(second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, 4, 2**31 - 1)
        one = F.substring_index(rest, second, 1)
        rest = F.substring(rest, F.char_length(one) + 4, F.lit(2**31 - 1))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.char_length(two) + 4, F.lit(2**31 - 1))

    prefix, suffix, middle = parts(SUFFIX)
    late_suffix, late_prefix, late_middle = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(late_prefix, late_middle, late_suffix))
        .otherwise(output)
    )
