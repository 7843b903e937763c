"""Token ids of documents in Simple-8b files."""

from __future__ import annotations

import io
import os
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from farebox.llm.common import column, slices, split_words
from farebox.llm.files import committed, opened, output_name, spread

# Spark runs one task for each core already.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END_ID = 2
# How many ids a word of 64 bits holds and the bits of each, by selector;
# selector 15 is one id of 60 bits.
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
    (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
# Selector 0 is the escape: the next word is one id of up to 64 bits, as it is. Selector 1
# is 120 zeros. The last word of a block is filled up with zeros.
ESCAPE = 0
USED = range(1, 16)
COUNTS = np.array([n for n, _ in SELECTORS])
# Bits of small numbers.
LENGTHS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)
# Ids of a block. Blocks are coded and decoded side by side, and can be read singly.
BLOCK_IDS = 1024
# Ids that are coded at once, and the places after a block that its last word may reach.
CODED_IDS = 1 << 19
PAD = 240
# A file is closed after this many ids, about 128 MB of words; a task has one at least.
FILE_IDS = 64 << 20
# Tasks whose files are placed together.
PARTS = 1000
READ_BYTES = 32 << 20
MAGIC = b"S8BT0001"
HEADER = struct.Struct("<8sIQQQ")

# Pieces whose ids a process remembers, in either of two generations.
REMEMBERED = 120_000


# ---- Simple-8b ------------------------------------------------------------------------


def packed(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """Ids as Simple-8b words, and where the words of each block begin (one entry more).

    Every word takes the selector that fits most of the next ids of its block. Blocks
    are coded side by side, CODED_IDS ids at a time.
    """
    at_once = max(1, CODED_IDS // block_ids) * block_ids
    words, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for start in range(0, len(ids), at_once):
        part, size = _packed(np.asarray(ids[start : start + at_once], np.uint64), block_ids)
        words.append(part)
        sizes.append(size)
    return np.concatenate(words), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


def _packed(ids: np.ndarray, block_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of some blocks, and how many each block has."""
    blocks, row = -(-len(ids) // block_ids), block_ids + PAD
    # A row for each block, zeros after its last id.
    values = np.zeros((blocks, row), np.uint64)
    full = len(ids) // block_ids
    values[:full, :block_ids] = ids[: full * block_ids].reshape(full, block_ids)
    rest = len(ids) - full * block_ids
    if rest:
        values[full, :rest] = ids[full * block_ids :]
    # widest[k]: the most bits that one of 2**k ids needs.
    if values.max(initial=0) < len(LENGTHS):
        widest = [LENGTHS[values]]
    else:
        # Rounded up where a double cannot tell, which makes an escape of it.
        widest = [np.frexp(values.astype(np.float64))[1].astype(np.uint8)]
    chosen = np.full((blocks, block_ids), ESCAPE, np.uint8)
    for selector in reversed(USED):
        n, bits = SELECTORS[selector]
        power = n.bit_length() - 1
        while len(widest) <= power:
            half = 1 << len(widest) - 1
            last = widest[-1]
            widest.append(np.maximum(last[:, :-half], last[:, half:]))
        top, shift = widest[power], n - (1 << power)
        most = np.maximum(top[:, :block_ids], top[:, shift : shift + block_ids])
        fits = most <= bits
        if not fits.any():
            break
        chosen[fits] = selector
    # The places where a word begins: step by step, in all blocks at once.
    begins = np.zeros((blocks, block_ids), bool)
    ends = np.full(blocks, block_ids)
    if rest:
        ends[full] = rest
    block, at = np.arange(blocks), np.zeros(blocks, np.int64)
    while len(at):
        begins[block, at] = True
        at = at + np.where(chosen[block, at] == ESCAPE, 1, COUNTS[chosen[block, at]])
        live = at < ends[block]
        block, at = block[live], at[live]
    block, at = np.nonzero(begins)
    selector = chosen[block, at].astype(np.int64)
    taken = 1 + (selector == ESCAPE)
    place = np.cumsum(taken) - taken
    words = np.zeros(int(taken.sum()), np.uint64)
    source, flat = block * row + at, values.ravel()
    escaped = selector == ESCAPE
    words[place[escaped] + 1] = flat[source[escaped]]
    for number in USED:
        n, bits = SELECTORS[number]
        mine = np.flatnonzero(selector == number)
        if len(mine):
            shifts = (4 + bits * np.arange(n)).astype(np.uint64)
            parts = flat[source[mine][:, None] + np.arange(n)] << shifts if bits else 0
            words[place[mine]] = number
            if bits:
                words[place[mine]] |= np.bitwise_or.reduce(parts, axis=1)
    return words, np.bincount(block, taken, blocks).astype(np.int64)


def unpacked(
    words: np.ndarray, offsets: np.ndarray, count: int, block_ids: int = BLOCK_IDS
) -> np.ndarray:
    """The ids of Simple-8b words; the inverse of ``packed``."""
    at_once = max(1, CODED_IDS // block_ids)
    out = [np.zeros(0, np.uint64)]
    for first in range(0, len(offsets) - 1, at_once):
        cuts = offsets[first : first + at_once + 1]
        left = count - first * block_ids
        out.append(_unpacked(words[cuts[0] : cuts[-1]], cuts - cuts[0], block_ids)[:left])
    return np.concatenate(out)


def _unpacked(words: np.ndarray, offsets: np.ndarray, block_ids: int) -> np.ndarray:
    """The ids of whole blocks, zeros after the last one."""
    blocks, row = len(offsets) - 1, block_ids + PAD
    selector = (words & np.uint64(15)).astype(np.int64)
    # A word after an escape is an id, not a selector; in a row of them every other one.
    plain = np.ones(len(words), bool)
    for place in np.flatnonzero(selector == ESCAPE):
        if plain[place]:
            plain[place + 1] = False
    codes = np.flatnonzero(plain)
    selector = selector[codes]
    sizes = np.where(selector == ESCAPE, 1, COUNTS[selector])
    ends = np.cumsum(sizes)
    block = np.searchsorted(offsets, codes, side="right") - 1
    first = np.searchsorted(codes, offsets[:-1])
    target = block * row + (ends - sizes) - (ends - sizes)[first][block]
    out = np.zeros(blocks * row, np.uint64)
    escaped = selector == ESCAPE
    out[target[escaped]] = words[codes[escaped] + 1]
    for number in USED:
        n, bits = SELECTORS[number]
        mine = np.flatnonzero(selector == number)
        if len(mine) and bits:
            shifts = (4 + bits * np.arange(n)).astype(np.uint64)
            parts = (words[codes[mine]][:, None] >> shifts) & np.uint64((1 << bits) - 1)
            out[target[mine][:, None] + np.arange(n)] = parts
    return out.reshape(blocks, row)[:, :block_ids].ravel()


# ---- Tokenizing -----------------------------------------------------------------------


class WordTokens:
    """A tokenizer that cuts at white space, applied once to each different word.

    Words of letters, digits and printable ASCII are cut into pieces as the tokenizer's
    own pattern does, and pieces given to its model; all others go through the whole
    tokenizer. Ids are those of the whole text, since no piece and no normalisation
    reaches across white space.
    """

    # The tokenizer's pattern, for the characters of SIMPLE once lower-cased.
    PIECES = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+)"
    SIMPLE = r"^[!-~À-ÖØ-öø-ÿ]+$"
    SPECIAL = "<|"

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        # Ids that end a piece have this mark in the vocabulary.
        vocabulary = self.whole.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True
        # The ids of pieces, of recent ones and of earlier ones.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of some different pieces."""
        known, before = self.known, self.before
        found = [known.get(piece) or before.get(piece) for piece in pieces]
        missing = [n for n, ids in enumerate(found) if ids is None]
        for start in range(0, len(missing), 1000):
            part = missing[start : start + 1000]
            text = " ".join([pieces[n] for n in part])
            coded = self.model.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(coded.ids, np.uint32)
            data = ids.tobytes()
            cuts = [0, *((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()]
            for lo, hi, n in zip(cuts[:-1], cuts[1:], part, strict=True):
                found[n] = data[lo:hi]
        known.update(zip(pieces, found, strict=True))
        if len(known) > REMEMBERED:
            self.known, self.before = {}, known
        return found

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each word one after another, and where each word's begin."""
        simple = pc.and_not(
            pc.match_substring_regex(words, self.SIMPLE), pc.match_substring(words, self.SPECIAL)
        )
        odd = np.flatnonzero(~simple.to_numpy(zero_copy_only=False))
        lower = pc.utf8_lower(pc.if_else(simple, words, ""))
        # A word of letters is one piece.
        single = pc.utf8_is_alpha(lower)
        apart = pc.replace_substring_regex(lower.filter(pc.invert(single)), self.PIECES, r"\1 ")
        lower = pc.replace_with_mask(lower, pc.invert(single), apart)
        parts = pc.ascii_split_whitespace(lower)
        flat = parts.flatten()
        real = pc.greater(pc.binary_length(flat), 0)
        kept = np.cumsum(np.concatenate(([0], real.to_numpy(zero_copy_only=False))))
        offsets = parts.offsets.to_numpy().astype(np.int64)
        pieces = flat.filter(real).dictionary_encode()
        coded = self._ids(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, starts = _joined(coded)
        ids, cuts = _gathered(ids, starts, pieces.indices.to_numpy().astype(np.int64))
        starts = cuts[kept[offsets - offsets[0]]]
        if not len(odd):
            return ids, starts
        # The words in between are put in where they stand.
        own = [
            np.array(self.whole.encode(words[int(n)].as_py(), add_special_tokens=False).ids)
            for n in odd
        ]
        sizes = np.diff(starts)
        at = np.repeat(starts[odd], [len(x) for x in own])
        ids = np.insert(ids, at, np.concatenate(own).astype(np.uint32))
        sizes[odd] = [len(x) for x in own]
        return ids, np.concatenate(([0], np.cumsum(sizes)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of every text, END_ID after each, and where each text's begin."""
        words, bounds = split_words(texts)
        flat, starts = self.words(words.dictionary)
        ids, ends = _gathered(flat, starts, words.indices.to_numpy().astype(np.int64))
        cuts = ends[bounds]
        marked = np.insert(ids, cuts[1:], END_ID)
        return marked.astype(np.uint32), cuts + np.arange(len(cuts))


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    return np.frombuffer(b"".join(parts), np.uint32), np.concatenate(([0], np.cumsum(sizes)))


def _gathered(
    values: np.ndarray, starts: np.ndarray, chosen: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` that are chosen, one after another, and where each begins."""
    sizes = np.diff(starts)[chosen]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    # Each value is taken from its run's place, plus how far it is into the run.
    source = np.repeat(starts[:-1][chosen] - ends[:-1], sizes) + np.arange(ends[-1])
    return values[source] if len(source) else np.zeros(0, np.uint32), ends


_tokenizers: dict[str, WordTokens] = {}


def tokenizer(path: str) -> WordTokens:
    """The tokenizer of a file, kept by the process for its later tasks.

    Where a machine does not have the path, the file of that name that Spark has sent it.
    """
    if path not in _tokenizers:
        there = path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))
        _tokenizers[path] = WordTokens(there)
    return _tokenizers[path]


# ---- Files ----------------------------------------------------------------------------


class TokenFile:
    """A file while it is filled: whole blocks as words, the ids of an open block as they are.

    The file has a header, the documents and their numbers of ids, block offsets, and words.
    All numbers are little-endian. A document without an id has the flag 1.
    """

    def __init__(self):
        self.doc_ids: list[int | None] = []
        self.sizes = [np.zeros(0, np.int64)]
        self.words = [np.zeros(0, np.uint64)]
        self.block_words = [np.zeros(1, np.int64)]
        self.open = np.zeros(0, np.uint64)
        self.count = 0

    def add(self, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.sizes.append(sizes)
        self.count += len(ids)
        ids = np.concatenate((self.open, ids)) if len(self.open) else ids
        whole = len(ids) // BLOCK_IDS * BLOCK_IDS
        self._pack(ids[:whole])
        self.open = ids[whole:].copy()

    def _pack(self, ids: np.ndarray) -> None:
        words, offsets = packed(ids)
        self.words.append(words)
        self.block_words.append(np.diff(offsets))

    def parts(self) -> Iterator[bytes]:
        """The bytes of the file, which ends the open block."""
        self._pack(self.open)
        self.open = self.open[:0]
        offsets = np.cumsum(np.concatenate(self.block_words))
        yield HEADER.pack(MAGIC, BLOCK_IDS, len(self.doc_ids), self.count, int(offsets[-1]))
        yield np.array([doc or 0 for doc in self.doc_ids], "<i8").tobytes()
        yield np.array([doc is None for doc in self.doc_ids], "<u1").tobytes()
        yield np.concatenate(self.sizes).astype("<i8").tobytes()
        yield offsets.astype("<i8").tobytes()
        for words in self.words:
            yield words.astype("<u8").tobytes()


def file_parts(stream) -> tuple[list[int | None], np.ndarray, Iterator[np.ndarray]]:
    """The documents of a file, their numbers of ids, and all ids in runs of some blocks."""

    def read(kind: str, number: int) -> np.ndarray:
        data = stream.read(number * np.dtype(kind).itemsize)
        if len(data) != number * np.dtype(kind).itemsize:
            raise ValueError("a token file is cut off")
        return np.frombuffer(data, kind)

    magic, block_ids, documents, count, _ = HEADER.unpack(read("<u1", HEADER.size).tobytes())
    if magic != MAGIC:
        raise ValueError("not a token file")
    docs, flags, sizes = read("<i8", documents), read("<u1", documents), read("<i8", documents)
    offsets = read("<i8", -(-count // block_ids) + 1)

    def runs() -> Iterator[np.ndarray]:
        at_once = max(1, CODED_IDS // block_ids)
        for first in range(0, len(offsets) - 1, at_once):
            cuts = offsets[first : first + at_once + 1]
            left = min(at_once * block_ids, count - first * block_ids)
            words = read("<u8", int(cuts[-1] - cuts[0]))
            yield unpacked(words, cuts - cuts[0], left, block_ids)

    return [None if f else int(d) for d, f in zip(docs, flags, strict=True)], sizes, runs()


def file_bytes(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """A whole file."""
    file = TokenFile()
    file.add(doc_ids, sizes, ids)
    return b"".join(file.parts())


def file_content(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """The documents of a whole file, their numbers of ids, and all ids."""
    docs, sizes, runs = file_parts(io.BytesIO(data))
    return docs, sizes, np.concatenate([np.zeros(0, np.uint64), *runs])


def file_documents(stream) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray, list[bytes]]]:
    """Some documents of a file after the others: names, starts, sizes, ids in 32 bits.

    Held at a time are the ids of one run, and those of a document that goes on after it.
    """
    docs, sizes, runs = file_parts(stream)
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    low = got = 0
    held: list[np.ndarray] = []
    for run in chain(runs, [np.zeros(0, np.uint64)]):
        held.append(run.astype("<u4"))
        got += len(run)
        high = int(np.searchsorted(cuts, got, side="right")) - 1
        if high > low:
            ids, first = np.concatenate(held), cuts[low]
            ends = cuts[low : high + 1] - first
            values = [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield docs[low:high], cuts[low:high], sizes[low:high], values
            held, low = [ids[ends[-1] :].copy()], high


MANIFEST = "file string, part int, number int, documents long, ids long, bytes long"


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode every document and write the ids to files in ascending order of document ids.

    Rows without an id come last; rows with one id are ordered by a hash of the text, and
    equal ones in any order. Files are coded as texts arrive, so that a task holds no more
    than the words of one file. Returns the manifest: the files, ordered by part and number.
    """
    rows = docs.select(
        column(docs, id_column).cast("long").alias("id"),
        column(docs, text_column).cast("string").alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    # The number of a row parts copies of one row, so that ranges can divide them.
    order = [F.col("id").asc_nulls_last(), "mark", "row"]
    sorted_rows = (
        rows.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        system.create_dir(base)
        name, coder = output_name(".s8b"), tokenizer(tokenizer_path)
        part, done = TaskContext.get().partitionId(), []
        file = TokenFile()

        def close() -> None:
            path, size = name(), 0
            with system.open_output_stream(f"{base}/{path}") as out:
                for data in file.parts():
                    out.write(data)
                    size += len(data)
            done.append(
                (f"{folder}/{path}", part, len(done), len(file.doc_ids), file.count, size)
            )

        for batch in slices(batches, "text", 3 << 20):
            ids, cuts = coder.encode(batch.column("text"))
            file.add(batch.column("id").to_pylist(), np.diff(cuts), ids)
            if file.count >= FILE_IDS:
                close()
                file = TokenFile()
        if file.doc_ids:
            close()
        file = None
        # The process stays for other tasks, of other operators too.
        pa.default_memory_pool().release_unused()
        names = [field.split()[0] for field in MANIFEST.split(", ")]
        columns = list(zip(*done, strict=True)) if done else [()] * len(names)
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    return committed(sorted_rows.mapInArrow(write, MANIFEST), f"{folder}/manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids as little-endian 32-bit integers) of every document.

    ``start`` is the number of ids of all documents before it.
    """
    placed = _placed(manifest).select("file", "base", "bytes")
    files = spread(placed, "bytes", READ_BYTES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(
                batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True
            ):
                system, path = opened(file)
                with system.open_input_stream(path) as stream:
                    for docs, starts, sizes, values in file_documents(stream):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(docs, pa.int64()),
                                pa.array(starts + base),
                                pa.array(sizes),
                                pa.array(values, pa.binary()),
                            ],
                            ["id", "start", "n_tokens", "ids"],
                        )

    return files.select("file", "base").mapInArrow(
        read, "id long, start long, n_tokens long, ids binary"
    )


def _placed(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids in all files before each.

    Files are added up within the tasks of PARTS consecutive numbers, and only the sums of
    these over all.
    """
    rows = manifest.withColumn("parts", F.expr(f"part div {PARTS}"))
    sums = rows.groupBy("parts").agg(F.sum("ids").alias("sum"))
    earlier = Window.orderBy("parts").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("parts", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("low"))
    before = (
        Window.partitionBy("parts")
        .orderBy("part", "number")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = rows.withColumn("inside", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return inside.join(sums, "parts").withColumn("base", F.col("low") + F.col("inside"))
