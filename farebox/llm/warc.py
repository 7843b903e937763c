"""WARC archives of web pages: writing them, and reassembling their records."""

from __future__ import annotations

import gzip
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import column
from farebox.llm.files import committed, opened, output_name, spread

# Payloads below this many bytes are stored again rather than referred to.
MIN_REVISIT_BYTES = 1000
# A record's block is cut into segments of this many bytes, and its payload framed in
# chunks of that many.
SEGMENT_BYTES = 8192
CHUNK_BYTES = 4096
# A file is closed, and the next begun, after this many compressed bytes. A record may go
# on in the next file.
FILE_BYTES = 32 << 20
READ_BYTES = 16 << 20
# The date that all records of a run have.
DATE = "2024-01-01T00:00:00Z"

RECORDS = (
    "record_id string, page_id string, uri string, record_type string, refers_to string, "
    "segment int, total long, digest string, block binary"
)
PAYLOADS = (
    "record_id string, page_id string, uri string, record_type string, refers_to string, "
    "declared_digest string, payload binary, payload_bytes long, problem string"
)


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A payload in HTTP's chunked transfer framing."""
    out = [
        b"%x\r\n%b\r\n" % (len(part), part)
        for part in (payload[n : n + size] for n in range(0, len(payload), size))
    ]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is shorter or longer than it says")
        out.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record; headers without a value are left out, line breaks in values escaped."""
    lines = [f"{k}: {re.sub(r'[\r\n]', lambda m: f'%{ord(m[0]):02X}', v)}" for k, v in headers if v]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block + b"\r\n\r\n"


def page_records(
    page_id: str | None,
    uri: str | None,
    payload: bytes,
    digest: str,
    refers_to: str | None,
    refers_uri: str | None,
) -> Iterator[bytes]:
    """The record of a page, as a first segment and continuations if its block is long."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("Page-ID", page_id)]
    if refers_to is not None:
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
        yield record(
            [
                ("WARC-Type", "revisit"),
                ("WARC-Record-ID", name),
                *common,
                (
                    "WARC-Profile",
                    "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                ),
                ("WARC-Refers-To-Target-URI", refers_uri),
                ("Refers-To-Page-ID", refers_to),
                ("WARC-Payload-Digest", f"sha1:{digest}"),
                ("Content-Type", "application/http; msgtype=response"),
            ],
            head.encode(),
        )
        return
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = head + chunked(payload)
    parts = [block[n : n + SEGMENT_BYTES] for n in range(0, len(block), SEGMENT_BYTES)]
    single = len(parts) == 1
    yield record(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", name),
            *common,
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Segment-Number", None if single else "1"),
        ],
        parts[0],
    )
    for number, part in enumerate(parts[1:], 2):
        yield record(
            [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                ("WARC-Date", DATE),
                ("WARC-Target-URI", uri),
                ("WARC-Segment-Origin-ID", name),
                ("WARC-Segment-Number", str(number)),
                ("WARC-Segment-Total-Length", str(len(block)) if number == len(parts) else None),
            ],
            part,
        )


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Write a record for every page into ``folder``; returns the manifest (file, bytes).

    Of records with equal payloads of at least 1000 bytes, that with the largest page id
    is the response and the others revisit it; rows that share that id are all
    responses, as are rows without an id where none has one; beside rows with an id,
    those without revisit. A null page has an empty payload.
    """
    rows = pages.select(
        column(pages, id_column).alias("page_id"),
        column(pages, url_column).cast("string").alias("uri"),
        F.coalesce(column(pages, html_column).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html"))
    # Narrow rows, reduced before they are shuffled, and only of payloads that repeat.
    repeated = (
        rows.filter(F.octet_length("html") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.max("page_id").alias("refers_to"),
            F.max_by("uri", "page_id").alias("refers_uri"),
        )
        .filter("copies > 1 AND refers_to IS NOT NULL")
        .drop("copies")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    framed = rows.join(repeated, "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"),
        "uri",
        "html",
        "digest",
        F.when(other, F.col("refers_to")).cast("string").alias("refers_to"),
        F.when(other, F.col("refers_uri")).alias("refers_uri"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        system.create_dir(base)
        name = output_name(".warc.gz")
        out, file, size = None, None, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                page_id, uri, page, digest, refers_to, refers_uri = row
                data = page.encode()
                for piece in page_records(page_id, uri, data, digest, refers_to, refers_uri):
                    if out is None:
                        file, size = name(), 0
                        out = system.open_output_stream(f"{base}/{file}")
                    # A member for each record, so that a reader can start at any of them.
                    packed = gzip.compress(piece, 1, mtime=0)
                    out.write(packed)
                    size += len(packed)
                    if size >= FILE_BYTES:
                        out.close()
                        done.append((file, size))
                        out = None
        if out is not None:
            out.close()
            done.append((file, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{f}" for f, _ in done], pa.string()), pa.array([s for _, s in done], pa.int64())],
            ["file", "bytes"],
        )

    listing = framed.mapInArrow(write, "file string, bytes long")
    return committed(listing, f"{folder}/manifest")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers and blocks of a file of gzip members, one after another."""
    with gzip.GzipFile(fileobj=stream) as data:
        reader = io.BufferedReader(data, 1 << 20)
        while line := reader.readline():
            if not line.strip():
                continue
            headers: dict[str, str] = {}
            while (line := reader.readline()).strip():
                key, _, value = line.decode().partition(":")
                headers[key.lower()] = value.strip()
            length = int(headers["content-length"])
            block = reader.read(length)
            if len(block) != length:
                raise ValueError("a record is cut off")
            yield headers, block


def _payload(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _decoded(kind: str | None, block: bytes, problem: str | None):
    """(payload, its length, problem) of a whole block."""
    if problem is None and kind == "revisit":
        length = re.search(rb"content-length:\s*(\d+)", block, re.IGNORECASE)
        return None, int(length[1]) if length else None, None
    if problem is None:
        try:
            payload = _payload(block)
            return payload, len(payload), None
        except ValueError as error:
            problem = f"chunked framing: {error}"
    return None, None, problem


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields, strict=True)],
        [name for name, _ in fields],
    )


def _grouped(rows: Iterator[tuple], schema: str, size_at: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[size_at] or b"") + 200
        if size >= 4 << 20:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


def _read(segmented: bool):
    """The records of the listed files: those in one piece, decoded; or all segments."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                system, path = opened(file)
                with system.open_input_stream(path) as stream:
                    for headers, block in records(stream):
                        number = headers.get("warc-segment-number")
                        if (number is not None) != segmented:
                            continue
                        kind = headers.get("warc-type")
                        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                        about = (
                            headers.get("warc-segment-origin-id") or headers.get("warc-record-id"),
                            headers.get("page-id"),
                            headers.get("warc-target-uri"),
                            kind,
                            headers.get("refers-to-page-id"),
                        )
                        if segmented:
                            total = headers.get("warc-segment-total-length")
                            yield (*about, int(number), total and int(total), digest or None, block)
                        else:
                            yield (*about, digest or None, *_decoded(kind, block, None))

    schema, size_at = (RECORDS, 8) if segmented else (PAYLOADS, 6)
    return lambda batches: _grouped(rows(batches), schema, size_at)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of segments sorted by (record, number); one record is held at a time."""

    def whole(parts: list[tuple]) -> tuple:
        first = parts[0]
        numbers = [part[5] for part in parts]
        total = parts[-1][6]
        size = sum(len(part[8]) for part in parts)
        problem = None
        if numbers != list(range(1, len(parts) + 1)):
            problem = f"segments {numbers[0]} to {numbers[-1]} are not all there, or repeat"
        elif total is None:
            problem = "the last segment is missing"
        elif total != size:
            problem = f"{size} bytes instead of {total}"
        block = b"".join(part[8] for part in parts) if problem is None else b""
        return (*first[:5], first[7], *_decoded(first[3], block, problem))

    def rows() -> Iterator[tuple]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][0] != row[0]:
                    yield whole(held)
                    held = []
                held.append(row)
        if held:
            yield whole(held)

    return _grouped(rows(), PAYLOADS, 6)


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the listed files with its payload; continuations joined to their origin.

    ``payload`` is null for revisits, whose ``payload_bytes`` come from the headers they
    keep, and for records with a ``problem``: segments missing or repeated, a total
    length that differs, or broken chunked framing.
    """
    files = spread(manifest, "bytes", READ_BYTES).select("file")
    single = files.mapInArrow(_read(segmented=False), PAYLOADS)
    segments = files.mapInArrow(_read(segmented=True), RECORDS)
    joined = (
        segments.repartition("record_id")
        .sortWithinPartitions("record_id", "segment")
        .mapInArrow(_reassemble, PAYLOADS)
    )
    return single.unionByName(joined)
