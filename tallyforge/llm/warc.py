"""WARC archives in seekable Zstandard bundles.

A bundle is one binary value: independent Zstandard frames of whole records, then a skippable frame with the seek
table (compressed and plain size of each frame).  The index maps a record id to (bundle, frame, offset inside the
plain frame, length), so one record is read by decompressing one frame.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded_batches, lookup_join, materialize, text_batches

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
ENTRY, FOOTER = struct.Struct("<II"), struct.Struct("<IBI")

FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 1 << 23
LEAST_BYTES = 100
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(ENTRY.pack(*s) for s in sizes) + FOOTER.pack(len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def frame_spans(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the footer alone."""
    n, flags, magic = FOOTER.unpack_from(bundle, len(bundle) - FOOTER.size)
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = ENTRY.size + (4 if flags & 0x80 else 0)
    first = len(bundle) - FOOTER.size - n * width
    if struct.unpack_from("<I", bundle, first - 8)[0] != SKIPPABLE_MAGIC:
        raise ValueError("the seek table does not begin with a skippable frame")
    sizes = [ENTRY.unpack_from(bundle, first + i * width) for i in range(n)]
    starts = accumulate((c for c, _ in sizes), initial=0)
    return [(at, c, d) for at, (c, d) in zip(starts, sizes)]


def read_frame(bundle: bytes, frame: int) -> bytes:
    at, packed, plain = frame_spans(bundle)[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[at : at + packed], max_output_size=plain) if plain else b""


def read_record(bundle: bytes, frame: int, offset: int, length: int) -> dict:
    return parse_record(read_frame(bundle, frame)[offset : offset + length])


def record_id(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    return int(name[len("<urn:x-page:") : -1]) if len(name) > len("<urn:x-page:>") else None


def make_record(page_id, url: str | None, payload: bytes, digest: str, first, date: str) -> bytes:
    """A response, or (first: the page that has the payload) a revisit with the HTTP head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {''.join(c if c > ' ' else '%%%02X' % ord(c) for c in url)}")
    if first is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(first)}"]
    block = http + (payload if first is None else b"")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse_record(data: bytes, at: int = 0) -> dict:
    """The record that begins at `at`: its fields, HTTP fields, payload, and where it ends."""
    if data[at : at + 5] != b"WARC/":
        raise ValueError(f"no record at {at}")
    stop = data.index(b"\r\n\r\n", at)
    fields = fields_of(data[at:stop])
    start, end = stop + 4, stop + 4 + int(fields["content-length"])
    http_stop = data.index(b"\r\n\r\n", start, end)
    return {"fields": fields, "http": fields_of(data[start:http_stop]), "payload": data[http_stop + 4 : end], "end": end + 4}


def bundles(date: str, frame_bytes: int, bundle_bytes: int):
    schema = pa.schema([
        ("bundle", pa.string()), ("data", pa.binary()),
        ("records", pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True)
        frames, sizes, index, plain, names = [], [], [], [], []

        def close_frame():
            raw = b"".join(plain)
            frames.append(pack.compress(raw))
            sizes.append((len(frames[-1]), len(raw)))
            at = accumulate((len(x) for x in plain), initial=0)
            index.extend({"record_id": n, "frame": len(frames) - 1, "offset": o, "length": len(x)} for n, o, x in zip(names, at, plain))
            plain.clear()
            names.clear()

        def close_bundle():
            data = b"".join(frames) + seek_table(sizes)
            name = hashlib.sha256(data).hexdigest()[:32]
            out = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary()), pa.array([list(index)], schema.field(2).type)], schema=schema)
            for x in (frames, sizes, index):
                x.clear()
            return out

        held = waiting = 0
        for batch in text_batches(batches, "html"):
            for page_id, url, html, digest, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first"))):
                plain.append(make_record(page_id, url, html, digest, first, date))
                names.append(record_id(page_id))
                held += len(plain[-1])
                waiting += len(plain[-1])
                if waiting >= frame_bytes:
                    close_frame()
                    waiting = 0
                if held >= bundle_bytes:
                    if plain:
                        close_frame()
                    yield close_bundle()
                    held = waiting = 0
        if plain:
            close_frame()
        if frames:
            yield close_bundle()

    return build


BUNDLE = "bundle string, data binary, records array<struct<record_id: string, frame: int, offset: bigint, length: bigint>>"


def write_warc(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Bundles (bundle, data, records) of a WARC record for every row of pages (page_id, url, html).

    Of rows with equal payloads of at least 100 bytes, those with the smallest page_id are responses and the others
    revisits of it.  Null html is the empty payload; a null page_id makes a response and is never referred to;
    repeated rows make repeated records; other columns are ignored; no rows make no bundles.
    """
    bounded_batches(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    slim = pages.filter((F.octet_length("html") >= LEAST_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    slim = materialize(slim, "warc-digests")
    first = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = lookup_join(slim, materialize(first, "warc-first"), "digest", "n").filter("page_id <> first").distinct()
    rows = pages.join(again, ["page_id", "digest"], "left")
    rows = rows.select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "first")
    return rows.mapInArrow(bundles(date, frame_bytes, bundle_bytes), BUNDLE)


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean, frame int, offset long, bundle string"


def scan_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in RECORD.split(", ")]
    for batch in batches:
        for name, value in zip(batch.column("bundle"), batch.column("data")):
            bundle = memoryview(value.as_buffer())
            for frame, (start, packed, plain) in enumerate(frame_spans(bundle)):
                data = zstandard.ZstdDecompressor().decompress(bundle[start : start + packed], max_output_size=plain)
                rows, at = [], 0
                while at < len(data):
                    r = parse_record(data, at)
                    f, told = r["fields"], r["fields"]["warc-payload-digest"].partition(":")[2]
                    if f["warc-type"] == "response":
                        size, digest = len(r["payload"]), hashlib.sha256(r["payload"]).hexdigest()
                    else:
                        size, digest = int(r["http"]["content-length"]), told
                    refers = page_of(f["warc-refers-to"]) if "warc-refers-to" in f else None
                    rows.append((page_of(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-type"], size, digest, refers, digest == told, frame, at, name.as_py()))
                    at = r["end"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_warc(bundles: DataFrame) -> DataFrame:
    """A row for each record in the bundles; payload size and digest of responses are taken from the bytes read."""
    return bundles.select("bundle", "data").mapInArrow(scan_bundles, RECORD)


def warc_index(bundles: DataFrame) -> DataFrame:
    """(record_id, bundle, frame, offset, length) of every record."""
    return bundles.select("bundle", F.explode("records").alias("r")).select("r.record_id", "bundle", "r.frame", "r.offset", "r.length")
