"""Quality rules: counts on whole texts, and bands of compression ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from farebox.llm.common import (
    fresh,
    mixed,
    numbered,
    owners,
    slices,
    split_words,
    window_hashes,
)

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
LEVEL = 3
CHUNK_BYTES = 4096
# Texts are also judged in pieces of this many bytes, the last with the rest.
PIECE_BYTES = 512
# Compressed over plain bytes, by plain bytes: from this length on, at least, at most.
# The frame of a short text weighs much; the longer a text, the more of it has been seen
# before, so both limits fall. The upper ones lie about halfway between prose (at most
# 0.92 from 128 bytes on, 0.72 from 512, 0.58 from 1,024, 0.48 from 4,096, by labelled texts
# and pieces of sf0.1) and random base64 in lines (at least 0.96, 0.81, 0.78, 0.76).
BANDS = (
    (0, 0.0, float("inf")),
    (128, 0.0, 0.945),
    (192, 0.0, 0.88),
    (256, 0.33, 0.82),
    (384, 0.33, 0.78),
    (512, 0.30, 0.77),
    (768, 0.30, 0.72),
    (1024, 0.27, 0.70),
    (2048, 0.27, 0.67),
    (4096, 0.23, 0.65),
    (16384, 0.20, 0.64),
)
# Of a fixed chunk; a text is rejected if more than this share of its chunks, or of the
# bytes of its pieces, is outside.
CHUNK_BAND = (0.20, 0.65)
MAX_CHUNKS_OUTSIDE = 0.25

COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, chunks_outside double, kept boolean"
)


def repeated_words(words: pa.DictionaryArray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the words in windows of five that occur twice or more in that text.

    Windows whose hash occurs once are left out first. The others are numbered
    exactly, word by word, so that no two different ones are taken for equal.
    """
    codes = words.indices.to_numpy().astype(np.int64)
    covered = np.zeros(len(codes) + 1, np.int64)
    size = len(words.dictionary)
    if len(codes) >= REPEAT_WINDOW:
        whose = owners(bounds)
        marks = mixed(np.arange(1, size + 1, dtype=np.uint64))[codes]
        inside = np.flatnonzero(
            whose[: len(codes) - REPEAT_WINDOW + 1] == whose[REPEAT_WINDOW - 1 :]
        )
        marks = window_hashes(marks, REPEAT_WINDOW)[inside]
        marks += mixed(whose[inside].astype(np.uint64))
        order = np.argsort(marks)
        same = np.flatnonzero(marks[order][1:] == marks[order][:-1])
        maybe = inside[order[np.union1d(same, same + 1)]]
        names = whose[maybe]
        for place in range(REPEAT_WINDOW):
            names = pd.factorize(names * size + codes[maybe + place])[0].astype(np.int64)
        twice = maybe[np.bincount(names)[names] > 1] if len(maybe) else maybe
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT_WINDOW, -1)
    hit = np.cumsum(covered[:-1]) > 0
    total = np.concatenate(([0], np.cumsum(hit)))
    return total[bounds[1:]] - total[bounds[:-1]]


def ratios(data: bytes, press: zstandard.ZstdCompressor) -> tuple[float, float]:
    """The compression ratio of a text, and the share of it outside the bands of its parts.

    The larger share of two: of the full chunks of CHUNK_BYTES, and of the bytes in pieces of
    PIECE_BYTES, each judged by its own length. Pieces cover the text to its end.
    """
    if not data:
        return 1.0, 0.0
    low, high = CHUNK_BAND
    outside = full = 0
    for start in range(0, len(data) - CHUNK_BYTES + 1, CHUNK_BYTES):
        size = len(press.compress(data[start : start + CHUNK_BYTES]))
        full += 1
        outside += not low * CHUNK_BYTES <= size <= high * CHUNK_BYTES
    odd = 0
    for start in range(0, max(len(data) - PIECE_BYTES, 0) + 1, PIECE_BYTES):
        last = start + 2 * PIECE_BYTES > len(data)
        piece = data[start:] if last else data[start : start + PIECE_BYTES]
        if not in_band(len(piece), len(press.compress(piece)) / len(piece)):
            odd += len(piece)
    shares = outside / full if full else 0.0, odd / len(data)
    return len(press.compress(data)) / len(data), max(shares)


def in_band(length: int, ratio: float) -> bool:
    low, high = next((lo, hi) for start, lo, hi in reversed(BANDS) if length >= start)
    return low <= ratio <= high


def duplicate_lines(data: bytes) -> int:
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measured(docs: DataFrame, text_column: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs`` with the counts, ratios and verdicts after them.

    Returns the frame and the names the new columns have: their own, unless ``docs``
    has such a column already. A null text counts as empty. A text that fails the base rules (fewer than
    10 words, or more than a fifth of them in repeated windows) is rejected; another
    is kept if its ratio lies within the band of its length and enough of its chunks
    and pieces within theirs. Empty texts fail for want of words. Every row, repeated ones
    too, stands for itself.
    """
    names = {field.split()[0]: field.split()[1] for field in COUNTS.split(", ")}
    own = {name: fresh(docs, name) for name in names}
    text = f"c{docs.columns.index(text_column)}"
    plain = numbered(docs)
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in plain.schema)}, {COUNTS}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in slices(batches, text):
            words, bounds = split_words(batch.column(text))
            repeats = repeated_words(words, bounds)
            rows = []
            for place, value in enumerate(batch.column(text)):
                whole = value.as_py() or ""
                data = whole.encode()
                count = int(bounds[place + 1] - bounds[place])
                repeat = int(repeats[place])
                failed = count < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * count
                ratio, outside = ratios(data, press)
                fits = in_band(len(data), ratio) and outside <= MAX_CHUNKS_OUTSIDE
                rows.append(
                    (
                        count,
                        len(whole) - sum(map(whole.count, SPACES)),
                        sum(map(whole.count, SYMBOLS)),
                        duplicate_lines(data),
                        repeat,
                        failed,
                        ratio,
                        outside,
                        fits and not failed,
                    )
                )
            new = [pa.array(list(values)) for values in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], [*batch.schema.names, *names]
            )

    return plain.mapInArrow(work, schema).toDF(*docs.columns, *own.values()), own


def passing(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents that the rules keep, in the columns of ``docs``."""
    frame, own = measured(docs, text_column)
    return frame.filter(f"`{own['kept']}`").drop(*own.values())
