"""Benchmark decontamination by template windows with typed slots."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from farebox.llm.common import (
    column,
    fresh,
    identity,
    mixed,
    owners,
    slices,
    split_words,
    stored,
    window_hashes,
)

# Words of a template window, and those of them that must not be placeholders. A text of a
# benchmark shorter than a window is one window. Windows with fewer such words are looked
# for as they are, with the values in their slots.
WINDOW = 8
MIN_LITERALS = 4
# What a whole short text with two numbers or more and no name needs instead.
MIN_BESIDE_NUMBERS = 3
# The share of an item's windows that a document must have; if only windows with slots are
# counted, the share of its words under them too.
MIN_SHARE = 0.5
# Windows of documents are looked up in a bitmap of the benchmark's windows first. It has
# this many bits (8 MB) whatever the size of the benchmark: the more windows there are, the
# more others pass it, all of which the join then sorts out.
BITMAP_BITS = 1 << 26

# Common units of measure.
UNITS = (
    "mm cm km kg mg ml kb mb gb tb hz khz mhz ghz kw kwh mph kmh km/h m/s m2 m3 % € $ £ "
    "percent meter meters metre metres kilometer kilometers kilometre kilometres mile miles "
    "foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces "
    "ton tons tonne tonnes liter liters litre litres gallon gallons second seconds minute minutes "
    "hour hours day days week weeks month months year years dollar dollars euro euros cent cents "
    "degree degrees volt volts watt watts joule joules newton newtons"
).split()
EDGES = "\"'`.,;:!?()[]{}<>*#&|~^_=+-/\\“”‘’«»„…–—"
NUMBER = r"^[$€£]?[+-]?[0-9][0-9.,:/]*(st|nd|rd|th|%|[a-z]{1,3}|[$€£])?$"
# By shape: a capital and then letters, with apostrophes, hyphens, dots or & between them.
NAME = r"^[\p{Lu}\p{Lt}][\p{L}\p{M}]*([-'’.&‐‑][\p{L}\p{M}]+)*$"
# A line break ends a sentence too; this stands for it.
BREAK = "\x1e"
SENTENCE_END = r"([.!?:][\"')\]]*|\x1e)$"
# Windows whose forms are made at a time: each has 163 of them at most.
FORMED = 1 << 14
WORD, NUMERIC, UNIT, TITLE = range(4)
# Placeholders, as the hashes that stand for them in a window.
MARKS = mixed(np.arange(1, 5, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
# Tells hashes of literal windows from those of templates.
LITERAL = np.uint64(0xA0761D6478BD642F)
NAMES = {NUMERIC: "<number>", UNIT: "<unit>", TITLE: "<name>"}


class Templates:
    """The words of some texts with names, numbers and units told apart.

    Words lose punctuation at their ends and are lower-cased; those that have
    nothing else are left out. A number has a digit and may carry a unit or ending; a
    unit follows a number; a name is a capitalised word. One that begins a sentence may
    be a name or a plain word (``maybe``).
    """

    def __init__(self, texts: pa.Array):
        words, bounds = split_words(
            pc.replace_substring_regex(texts, r"[\n\v\f\r]", f" {BREAK} ")
        )
        raw = words.dictionary
        trimmed = pc.utf8_trim(raw, characters=EDGES + BREAK)
        lower = pc.utf8_lower(trimmed)
        kind = np.full(len(raw), WORD, np.int8)
        title = pc.match_substring_regex(trimmed, NAME).to_numpy(zero_copy_only=False)
        kind[title] = TITLE
        kind[pc.is_in(lower, pa.array(UNITS)).to_numpy(zero_copy_only=False)] = UNIT
        numeric = pc.match_substring_regex(lower, NUMBER)
        kind[numeric.to_numpy(zero_copy_only=False)] = NUMERIC
        empty = pc.equal(pc.binary_length(lower), 0).to_numpy(zero_copy_only=False)
        ends = pc.match_substring_regex(raw, SENTENCE_END).to_numpy(zero_copy_only=False)
        hashes = pd.util.hash_array(np.asarray(lower.to_pylist(), dtype=object), categorize=False)

        codes = words.indices.to_numpy()
        first = np.zeros(len(codes), bool)
        first[bounds[:-1][bounds[:-1] < len(codes)]] = True
        first[1:] |= ends[codes[:-1]]
        real = np.flatnonzero(~empty[codes])
        before = np.concatenate(([0], np.cumsum(~empty[codes])))
        self.bounds = before[bounds]
        self.codes, self.values = codes[real], trimmed
        self.kinds = kind[self.codes]
        after_number = np.zeros(len(self.kinds) + 1, bool)
        after_number[1:] = self.kinds == NUMERIC
        after_number[self.bounds] = False
        loose = (self.kinds == UNIT) & ~after_number[:-1]
        self.kinds[loose] = np.where(title[self.codes[loose]], TITLE, WORD)
        self.maybe = (self.kinds == TITLE) & first[real]
        self.kinds[self.maybe] = WORD
        self.plain = hashes[self.codes].astype(np.uint64) if len(real) else np.zeros(0, np.uint64)
        self.tokens = np.where(self.kinds == WORD, self.plain, MARKS[self.kinds]).astype(np.uint64)

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places, forms and hashes of the windows inside one text with enough plain words.

        A form has a bit for each word of the window that begins a sentence and is taken
        for a name; a window comes in all forms that leave it enough plain words. One
        shorter than ``WINDOW``, which stands for a whole text, needs fewer of them beside
        two numbers or more, but then no word of it is taken for a name.
        """
        count, need = len(self.tokens) - size + 1, min(size, MIN_LITERALS)
        if count <= 0:
            return
        whose = owners(self.bounds)
        inside = whose[:count] == whose[size - 1 :]

        def number_of(kind: int) -> np.ndarray:
            sums = np.concatenate(([0], np.cumsum(self.kinds == kind)))
            return sums[size:] - sums[:count]

        known = number_of(WORD)
        enough = known >= need
        if size < WINDOW:
            sums = (number_of(NUMERIC) >= 2) & (number_of(TITLE) == 0)
            enough |= sums & (known >= MIN_BESIDE_NUMBERS)
        factors = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
        every = np.flatnonzero(inside & enough)
        for start in range(0, len(every), FORMED):
            places = every[start : start + FORMED]
            forms, plain = np.zeros(len(places), np.uint8), known[places]
            sums = np.zeros(len(places), np.uint64)
            for offset in range(size):
                sums += self.tokens[places + offset] * factors[offset]
            for offset in range(size):
                also = np.flatnonzero(self.maybe[places + offset] & (plain > need))
                if len(also):
                    change = MARKS[TITLE] - self.tokens[places[also] + offset]
                    sums = np.concatenate((sums, sums[also] + change * factors[offset]))
                    forms = np.concatenate((forms, forms[also] | np.uint8(1 << offset)))
                    plain = np.concatenate((plain, plain[also] - 1))
                    places = np.concatenate((places, places[also]))
            yield places, forms, mixed(sums)

    def literal_windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and hashes of all windows inside one text, and which lack a form.

        The hashes are of the words as they are, lower-cased, and differ from those of
        ``windows``. A window lacks a form that leaves it too few plain words.
        """
        sums = window_hashes(self.plain, size)
        whose = owners(self.bounds)
        places = np.flatnonzero(whose[: len(sums)] == whose[size - 1 : size - 1 + len(sums)])
        sure = np.concatenate(([0], np.cumsum((self.kinds == WORD) & ~self.maybe)))
        poor = sure[places + size] - sure[places] < min(size, MIN_LITERALS)
        return places, mixed(sums[places] ^ LITERAL), poor

    def spelled(self, place: int, size: int, form: int) -> tuple[str, list[str], list[int], bool]:
        """The template of a window, the values in its slots, and where in it they are."""
        words, slots, offsets = [], [], []
        for at in range(place, place + size):
            value = self.values[int(self.codes[at])].as_py()
            kind = TITLE if form >> (at - place) & 1 else int(self.kinds[at])
            words.append(NAMES.get(kind) or value.lower())
            if kind != WORD:
                slots.append(value)
                offsets.append(at - place)
        return " ".join(words), slots, offsets, False

    def literal(self, place: int, size: int) -> tuple[str, list[str], list[int], bool]:
        """A window as it is, in place of its template; it has no slots."""
        values = (self.values[int(code)].as_py() for code in self.codes[place : place + size])
        return " ".join(values).lower(), [], [], True


WINDOWS = (
    "id long, row_hash long, length int, pos int, mark long, template string, "
    "slots array<string>, offsets array<int>, literal boolean"
)

HASHED = ("mark", "length", "literal")
JOINED = (*HASHED, "template")
ITEM = ("item_id", "item_hash")


def _rows(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found, strict=True) if found else ((),) * 8
    owner, length, pos, mark, template, slots, offsets, literal = columns
    taken = pa.array(owner, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id").take(taken),
            batch.column("row_hash").take(taken),
            pa.array(length, pa.int32()),
            pa.array(pos, pa.int32()),
            pa.array(np.array(mark, np.uint64).view(np.int64)),
            pa.array(template, pa.string()),
            pa.array(slots, pa.list_(pa.string())),
            pa.array(offsets, pa.list_(pa.int32())),
            pa.array(literal, pa.bool_()),
        ],
        [field.split()[0] for field in WINDOWS.split(", ")],
    )


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        column(docs, id_column).cast("long").alias("id"),
        identity(docs)[0].alias("row_hash"),
        column(docs, text_column).cast("string").alias("text"),
    )


def benchmark_windows(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Every window of the benchmark; an item of fewer words is one window.

    Windows come as templates, and as they are if a form of theirs has too few plain words.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = Templates(batch.column("text"))
            sizes = np.diff(made.bounds)
            found = []
            for size in sorted({min(int(n), WINDOW) for n in sizes if n}):
                for places, forms, marks in made.windows(size):
                    whose = owners(made.bounds)[places]
                    fits = (sizes[whose] == size) if size < WINDOW else (sizes[whose] >= WINDOW)
                    for place, owner, form, mark in zip(
                        *(x[fits].tolist() for x in (places, whose, forms, marks)), strict=True
                    ):
                        pos = place - int(made.bounds[owner])
                        found.append((owner, size, pos, mark, *made.spelled(place, size, form)))
                places, marks, poor = made.literal_windows(size)
                whose = owners(made.bounds)[places]
                poor &= (sizes[whose] == size) if size < WINDOW else (sizes[whose] >= WINDOW)
                for place, owner, mark in zip(
                    places[poor].tolist(), whose[poor].tolist(), marks[poor].tolist(), strict=True
                ):
                    pos = place - int(made.bounds[owner])
                    found.append((owner, size, pos, mark, *made.literal(place, size)))
            yield _rows(batch, found)

    return _texts(benchmark, id_column, text_column).mapInArrow(work, WINDOWS)


def bitmap(windows: DataFrame) -> tuple[np.ndarray, list[tuple[int, bool]]]:
    """A bit for each window hash of the benchmark, and its lengths and kinds (16 at most)."""
    word = F.pmod("mark", F.lit(BITMAP_BITS))
    # One row per 64 bits that are set at all, so 2**20 at most.
    rows = (
        windows.groupBy((word / 64).cast("int").alias("at"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (word % 64).cast("int"))).alias("bits"))
        .collect()
    )
    bits = np.zeros(BITMAP_BITS // 64, np.uint64)
    for at, value in rows:
        bits[at] = value & 0xFFFFFFFFFFFFFFFF
    return bits, [tuple(row) for row in windows.select("length", "literal").distinct().collect()]


def known_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The windows of ``docs`` (id, row_hash, text) whose hash the bitmap of the benchmark has."""
    bits, kinds = bitmap(windows)
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches, "text"):
            made = Templates(batch.column("text"))
            found = []
            for size, literal in kinds:
                if literal:
                    places, marks, _ = made.literal_windows(size)
                    groups = [(places, np.zeros(len(places), np.uint8), marks)]
                else:
                    groups = made.windows(size)
                for places, forms, marks in groups:
                    at = marks % np.uint64(BITMAP_BITS)
                    hit = (known[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
                    whose = owners(made.bounds)[places[hit]]
                    for place, owner, form, mark in zip(
                        places[hit].tolist(), whose.tolist(), forms[hit].tolist(),
                        marks[hit].tolist(), strict=True,
                    ):
                        pos = place - int(made.bounds[owner])
                        spelled = (
                            made.literal(place, size) if literal else made.spelled(place, size, form)
                        )
                        found.append((owner, size, pos, mark, *spelled))
            yield _rows(batch, found)

    return docs.mapInArrow(work, WINDOWS)


def _item_names() -> list[Column]:
    return [F.col("id").alias("item_id"), F.col("row_hash").alias("item_hash")]


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join in which null keys meet, with one column of each key."""
    other = right.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(other, on, how).drop(*[f"_{k}" for k in keys])


def _rarest(order: str, within: WindowSpec, min_share: float) -> Column:
    """Whether a row is one of the rarest, of which some must be among any ``min_share`` of all."""
    total = F.count(F.lit(1)).over(within)
    need = F.greatest(F.lit(1), F.ceil(total * F.lit(min_share) - F.lit(1e-6)))
    return F.row_number().over(within.orderBy(order, "pos")) <= total - need + 1


def candidates(mine: DataFrame, windows: DataFrame, min_share: float) -> DataFrame:
    """(id, row_hash, item_id, item_hash): the documents that may hold an item, and the item.

    Of an item's T windows a document must have ``need``, hence one at least of any
    T - need + 1, and likewise of those with slots. These are taken to be the ones that
    documents have least often, so that what many items and documents share, such as an
    instruction before each question, brings nobody together unless it is most of the item.
    """
    met = mine.groupBy(*HASHED).agg(F.count(F.lit(1)).alias("n"))
    theirs = windows.select(*_item_names(), "pos", *HASHED).distinct()
    typed = ~F.col("literal")
    places = (
        theirs.join(met, [*HASHED], "left")
        .fillna(0, "n")
        .groupBy(*ITEM, "pos")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(typed, F.col("n"))).alias("typed_n"),
            F.bool_or(typed).alias("typed"),
            F.collect_list(F.struct(*HASHED)).alias("forms"),
        )
    )
    every, alike = Window.partitionBy(*ITEM), Window.partitionBy(*ITEM, "typed")
    rare = places.select(
        *ITEM,
        "forms",
        _rarest("n", every, min_share).alias("rare"),
        (F.col("typed") & _rarest("typed_n", alike, min_share)).alias("rare_typed"),
    )
    forms = rare.filter("rare OR rare_typed").select("*", F.explode("forms").alias("form"))
    sought = forms.select(*ITEM, "rare", "form.*").filter(F.col("rare") | typed)
    sought = sought.select(*ITEM, *HASHED).distinct()
    return mine.join(sought, [*HASHED]).select("id", "row_hash", *ITEM).distinct()


def shared_windows(mine: DataFrame, windows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The windows of documents and items of ``pairs`` that have one template.

    Items bring their windows to their documents, so that a document's windows meet
    those of its own items only.
    """
    theirs = windows.select(
        *_item_names(),
        F.col("pos").alias("item_pos"),
        F.col("slots").alias("item_slots"),
        *JOINED,
    )
    wanted = null_safe(pairs, theirs, ITEM, "inner")
    return null_safe(mine, wanted, ["id", "row_hash", *JOINED], "inner").select(
        *("id", "row_hash", "pos", "slots", "offsets", "literal"),
        *("item_id", "item_hash", "item_pos", "item_slots"),
    )


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """(id, row_hash, item_id, share, reparameterised) for each document and item it holds.

    An alignment is a fixed distance between places in document and item. In it, a
    value of the item stands for the value of the document that it meets at most
    places; windows in which it meets another one are left out, and if no value is ahead
    all windows with it. Two values of the item may meet the same one. A document
    holds an item if the windows left of its alignments are at least ``min_share`` of all;
    or if those that are templates are that share of all such windows, so that values may
    differ in the others, and that share of the item's words is under them. ``share`` is
    the larger of the two that count. It is re-parameterised if any slot of theirs differs.
    Rows without text hold nothing, nor does any row if one of the tables is empty; rows
    that are equal in every column appear once, rows without an id with a null id. Texts
    longer than a slice are held one at a time, with some arrays of a few numbers a word.
    """
    windows = stored(benchmark_windows(benchmark, item_id_column, item_text_column), "windows")
    mine = stored(known_windows(_texts(docs, id_column, text_column), windows), "known")
    pairs = candidates(mine, windows, min_share)
    shared = stored(shared_windows(mine, windows, pairs), "shared")
    one = ["id", "row_hash", *ITEM]
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    here = [*one, "shift"]

    lowered = [F.transform(c, F.lower).alias(c) for c in ("item_slots", "slots")]
    aligned = shared.select(*one, shift, "item_pos", *lowered, "offsets", "literal")
    slot = F.explode(F.arrays_zip("item_slots", "slots", "offsets")).alias("slot")
    slots = aligned.select(*here, "item_pos", slot).select(
        *here,
        "item_pos",
        (F.col("item_pos") + F.col("slot.offsets")).alias("at"),
        F.col("slot.item_slots").alias("theirs"),
        F.col("slot.slots").alias("mine"),
    )
    votes = slots.select(*here, "at", "theirs", "mine").distinct()
    votes = votes.groupBy(*here, "theirs", "mine").agg(F.count(F.lit(1)).alias("n"))
    # The first and the last of the values met most often; the same one unless they are level.
    first, last = F.min(F.struct(-F.col("n"), "mine")), F.max(F.struct("n", "mine"))
    stands = votes.groupBy(*here, "theirs").agg(
        F.when(first["mine"] == last["mine"], last["mine"]).alias("meant")
    )
    clashes = null_safe(slots, stands, [*here, "theirs"], "inner")
    clashes = clashes.filter("meant IS NULL OR mine != meant").select(*here, "item_pos").distinct()
    sound = null_safe(aligned, clashes, [*here, "item_pos"], "left_anti")
    typed = F.when(~F.col("literal"), F.col("item_pos"))
    covered = sound.groupBy(*one).agg(
        F.count_distinct("item_pos").alias("covered"),
        F.array_sort(F.collect_set(typed)).alias("typed"),
        F.bool_or(F.col("item_slots") != F.col("slots")).alias("reparameterised"),
    )
    totals = windows.groupBy(*_item_names()).agg(
        F.count_distinct("pos").alias("total"),
        F.count_distinct(F.when(~F.col("literal"), F.col("pos"))).alias("templates"),
        F.max("length").alias("length"),
    )
    held = null_safe(covered, totals, ITEM, "inner")
    # From each window with slots to the next, but no further than the window goes.
    under = F.expr(
        "aggregate(zip_with(typed, slice(typed, 2, greatest(size(typed) - 1, 0)), (here, next) -> "
        "least(length, coalesce(next - here, length))), 0, (sum, n) -> sum + n)"
    )
    words = F.col("total") + F.col("length") - 1
    slots_share = F.when(
        under / words >= min_share, F.try_divide(F.size("typed"), F.col("templates"))
    )
    held = held.withColumn("share", F.greatest(F.col("covered") / F.col("total"), slots_share))
    return held.filter(F.col("share") >= min_share).select(
        "id", "row_hash", "item_id", "share", "reparameterised"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each document that holds benchmark items: (id, items, share, …).

    ``items`` are their ids in order, ``share`` the largest share. Documents with one
    id count as one. The arguments are those of ``matches``.
    """
    name = options.get("id_column", "doc_id")
    found = matches(docs, benchmark, **options)
    return found.groupBy(F.col("id").alias(name)).agg(
        F.array_sort(F.collect_set("item_id")).alias("items"),
        F.max("share").alias("share"),
        F.bool_or("reparameterised").alias("reparameterised"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, in the columns of ``docs``."""
    name = fresh(docs, "row_hash")
    held = matches(docs, benchmark, **options).select(F.col("row_hash").alias(name)).distinct()
    marked = docs.withColumn(name, identity(docs)[0])
    return marked.join(stored(held, "held"), name, "left_anti").drop(name)
