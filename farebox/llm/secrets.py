"""Secrets in texts: fixed patterns, and zstandard novelty of strings in sensitive places."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import column, owners, slices, split_words

# The base patterns, and how long a match has to be.
ASSIGN = (
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "novel")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Words near which a string may be a secret, looked for in the characters before it, and in
# those after it on its line. The lines of an encoded block are as near as its first one.
SENSITIVE = (
    r"(?i)(passphrase|password|passwd|pwd|secret|token|api[ _-]?key|private[ _-]?key"
    r"|access[ _-]?key|credential|authorization|bearer|signing[ _-]?key|client[ _-]?id"
    r"|session[ _-]?id)"
)
REACH = 48
# A candidate: a run of key characters at least this long, whichever they are.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
# The text around a candidate that primes the compressor, on either side.
CONTEXT = 2048
# The surroundings that are compressed once more before a candidate.
LEAD = 256
# Reported from this many compressed bytes for each plain one. Measured: identifiers of usual
# words and long words 0.1 to 0.62, 20 random small letters 0.65, 40 of them 0.68, random
# base64 and hexadecimal 0.83 and more.
NOVELTY = 0.64
# Parts of words that the dictionary takes from the texts: runs of letters of one case, too
# few for a candidate, and in at least so many texts; the most frequent, so many at most.
PARTS = re.compile(r"[A-Z][a-z]{3,14}|[a-z]{4,15}|[A-Z]{4,15}")
MIN_TEXTS, MAX_WORDS = 3, 4096
# Identifiers and values that turn up near such words without being secret.
IDENTIFIERS = (
    b"password passwd secret token api_key apiKey access_key accessKey private_key privateKey "
    b"client_id client_secret authorization Authorization: Bearer credentials session_id "
    b"username user_name environment configuration production development staging example "
    b"your_api_key_here your-token-here changeme placeholder undefined default required "
    b"https://www. http:// localhost application/json text/html utf-8 Content-Type "
    b"getElementById addEventListener querySelector process.env os.environ System.getenv "
    b"abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx"
)

_assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_access = re.compile(ACCESS)
_long_hex = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
_sensitive, _candidate = re.compile(SENSITIVE, re.ASCII), re.compile(CANDIDATE)

# What a text must contain to have any span: checked by a linear-time engine first.
ANY = "|".join([SENSITIVE, r"(?i:api_?key)", r"AKIA[A-Z0-9]{16}", r"[0-9a-f]{%d}" % MIN_HEX])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in code points, by start and kind.

    Matches of a kind are found from the left and do not overlap; too short ones are
    dropped after that, so what they cover is not searched again.
    """
    found = [
        (m.start(), 0, m.end()) for m in _assign.finditer(text) if len(m[2]) >= MIN_ASSIGNED
    ]
    found += [(m.start(), 1, m.end()) for m in _access.finditer(text) if len(m[0]) >= MIN_ACCESS]
    # A run of hexadecimal digits is matched whole, so the long ones can be asked for.
    found += [(m.start(), 2, m.end()) for m in _long_hex.finditer(text)]
    return sorted(found)


def identifiers(docs: DataFrame, text_column: str = "text") -> bytes:
    """The dictionary of words that are usual where sensitive words are.

    Counts, over all texts with such a word, in how many of them each part of a word is: of
    an identifier, the words it is made of. At most MAX_WORDS come back, the most frequent
    last, where matches cost least.
    """
    rows = docs.select(column(docs, text_column).cast("string").alias("text"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            near = pc.fill_null(pc.match_substring_regex(batch.column("text"), SENSITIVE), False)
            found, bounds = split_words(batch.column("text").filter(near))
            # The parts of each different word, then each part once for each text.
            split = [PARTS.findall(word) for word in found.dictionary.to_pylist()]
            sizes = np.array([len(parts) for parts in split], np.int64)
            parts = pa.array([p for parts in split for p in parts], pa.string())
            coded = parts.dictionary_encode()
            index = found.indices.to_numpy().astype(np.int64)
            ends = np.cumsum(sizes[index])
            first = np.cumsum(sizes) - sizes
            place = np.repeat(first[index] - ends + sizes[index], sizes[index])
            place += np.arange(len(place))
            whose = np.repeat(owners(bounds), sizes[index])
            names = coded.indices.to_numpy()[place] if len(place) else np.zeros(0, np.int64)
            width = max(1, len(coded.dictionary))
            pairs = np.unique(whose * width + names)
            names, texts = np.unique(pairs % width, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(names)), pa.array(texts)], ["word", "texts"]
            )

    counts = rows.mapInArrow(words, "word string, texts long").groupBy("word")
    top = (
        counts.agg(F.sum("texts").alias("texts"))
        .filter(F.col("texts") >= MIN_TEXTS)
        .orderBy(F.col("texts").desc(), "word")
        .limit(MAX_WORDS)
    )
    return " ".join(row["word"] for row in reversed(top.collect())).encode()


def novelty(candidate: str, around: str, known: bytes = b"") -> float:
    """The compressed bytes that ``candidate`` adds to its surroundings, for each of its own.

    Known identifiers and the surroundings, without further occurrences of the candidate
    itself, prime the compressor as a raw dictionary. What is compressed is a list of usual
    names and the nearest words, once with and once without the candidate behind them: on its
    own, a string is too short to be compressed at all.
    """
    near = around.replace(candidate, " ").encode()
    primed = zstandard.ZstdCompressionDict(
        known + b" " + near, dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    press = zstandard.ZstdCompressor(
        level=9, dict_data=primed, write_content_size=False, write_dict_id=False
    )
    before = IDENTIFIERS + near[-LEAD:] + b" "
    data = candidate.encode()
    return (len(press.compress(before + data)) - len(press.compress(before))) / len(data)


def _near(text: str, start: int, end: int) -> bool:
    """Whether a sensitive word is before a string, or after it on its line."""
    if _sensitive.search(text, max(0, start - REACH), start):
        return True
    stop = text.find("\n", end, end + REACH)
    return bool(_sensitive.search(text, end, end + REACH if stop < 0 else stop))


def novel_spans(
    text: str, base: list[tuple[int, int, int]], known: bytes = b""
) -> list[tuple[int, int, int]]:
    """Further strings in sensitive places that do not follow from what surrounds them."""
    found = []
    last_end, last_near = 0, False
    for match in _candidate.finditer(text):
        start, end = match.span()
        # A line of a block goes on from the line before.
        goes_on = last_near and text[last_end:start] in ("\n", "\r\n")
        near = goes_on or _near(text, start, end)
        last_end, last_near = end, near
        if not near or any(start < b and a < end for a, _, b in base):
            continue
        around = text[max(0, start - CONTEXT) : start] + text[end : end + CONTEXT]
        if novelty(match[0], around, known) >= NOVELTY:
            found.append((start, 3, end))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(
    text: str, known: bytes = b""
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans of a text, and all spans."""
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base, known))


SPANS = (
    "n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"
)


def secrets(
    docs: DataFrame, known: bytes = b"", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_novel, base_sha256, spans) of every document.

    ``spans`` lists kind:start:end in code points, ends exclusive, by start and then
    kind; ``base_sha256`` is the hash of that list without the novel strings. ``known`` is
    the dictionary of usual words (``identifiers``). Null and empty texts have no spans, and
    an empty table no rows. Repeated rows are each scanned. A text of any length is held
    whole, and nothing with it but its spans.
    """
    rows = docs.select(
        column(docs, id_column).alias("id"), column(docs, text_column).cast("string").alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
        for batch in slices(batches, "text"):
            some = pc.fill_null(pc.match_substring_regex(batch.column("text"), ANY), False)
            out = []
            for place, maybe in enumerate(some.to_pylist()):
                if not maybe:
                    out.append(nothing)
                    continue
                base, spans = scan(batch.column("text")[place].as_py(), known)
                counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                out.append((*counts, digest, joined(spans)))
            new = [pa.array(list(values)) for values in zip(*out, strict=True)]
            names = [field.split()[0] for field in SPANS.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *new], ["id", *names])

    return rows.mapInArrow(work, f"id {kind}, {SPANS}").withColumnRenamed("id", id_column)
