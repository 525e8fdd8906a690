"""Media columns: Ogg containers.

A container is a sequence of pages.  Each page carries a segment table of lacing values: a packet is the run of
segments up to the first one shorter than 255 bytes, and may go on over pages of the same logical stream.  Pages
of several streams are interleaved; a granule position tells where in its stream the last packet that ends on the
page ends.  The reader trusts nothing: it looks for the capture pattern, checks each page's checksum, demultiplexes
by serial number, notes missing sequence numbers, and turns granule positions into seconds.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded_batches

#: Fixed values of the container format.
CAPTURE = b"OggS"
HEAD = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
NO_PACKET_ENDS = -1

#: Our streams: 8-bit mono samples in packets of 4080 bytes, and a comment stream beside them.
RATE = 8000
PACKET = 4080
PCM_HEAD = struct.Struct("<8sBBHIQ")  # name, version, channels, bits, rate, samples

FLIP = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def page_checksum(page: bytes) -> int:
    """CRC-32 with polynomial 0x04C11DB7, no reflection, start and end value 0.

    zlib computes the reflected form; flipping the bits of each byte and of the result gives this one.
    """
    reflected = zlib.crc32(page.translate(FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(reflected.to_bytes(4, "little").translate(FLIP), "big")


def make_page(serial: int, number: int, granule: int, flags: int, lacing: bytes, body: bytes) -> bytes:
    page = HEAD.pack(CAPTURE, 0, flags, granule, serial, number, 0, len(lacing)) + lacing + body
    return page[:22] + struct.pack("<I", page_checksum(page)) + page[26:]


def write_stream(serial: int, packets: Iterable[tuple[bytes, int]]) -> Iterator[bytes]:
    """Pages of one logical stream from (packet, granule position at its end)."""
    lacing, body, flags, number, granule = bytearray(), [], FIRST, 0, NO_PACKET_ENDS
    ready = None
    for packet, end in packets:
        table = b"\xff" * (len(packet) // 255) + bytes([len(packet) % 255])
        at = 0
        while table:
            room = 255 - len(lacing)
            if not room:
                if ready:
                    yield make_page(serial, *ready)
                ready = (number, granule, flags, bytes(lacing), b"".join(body))
                number, granule, lacing, body = number + 1, NO_PACKET_ENDS, bytearray(), []
                flags = CONTINUED if at else 0
                room = 255
            now, table = table[:room], table[room:]
            lacing += now
            body.append(packet[at : at + sum(now)])
            at += sum(now)
        granule = end
        if number == 0 and flags & FIRST:  # the head packet has the first page to itself
            ready = (number, granule, flags, bytes(lacing), b"".join(body))
            number, granule, flags, lacing, body = 1, NO_PACKET_ENDS, 0, bytearray(), []
    if lacing:
        if ready:
            yield make_page(serial, *ready)
        ready = (number, granule, flags, bytes(lacing), b"".join(body))
    if ready:
        yield make_page(serial, ready[0], ready[1], ready[2] | LAST, *ready[3:])


def interleave(*streams: Iterator[bytes]) -> bytes:
    """First pages of all streams, then their other pages in turn."""
    out, rest = [], []
    for s in streams:
        out.append(next(s))
        rest.append(s)
    while rest:
        for s in list(rest):
            page = next(s, None)
            if page is None:
                rest.remove(s)
            else:
                out.append(page)
    return b"".join(out)


def write_ogg(samples: bytes, comment: bytes = b"", serial: int = 1, rate: int = RATE) -> bytes:
    """8-bit mono samples and a comment as two logical streams of one container."""

    def audio():
        yield PCM_HEAD.pack(b"PCM8    ", 1, 1, 8, rate, len(samples)), 0
        for at in range(0, len(samples), PACKET):
            yield samples[at : at + PACKET], min(at + PACKET, len(samples))

    def notes():
        yield b"NOTE    ", 0
        yield comment, len(samples)

    return interleave(write_stream(serial, audio()), write_stream(serial + 1, notes()))


def read_pages(data: bytes) -> Iterator[dict]:
    """All pages whose checksum holds; after damage the next capture pattern is looked for."""
    at = 0
    while (at := data.find(CAPTURE, at)) >= 0:
        if at + HEAD.size > len(data):
            return
        _, version, flags, granule, serial, number, crc, n = HEAD.unpack_from(data, at)
        lacing = data[at + HEAD.size : at + HEAD.size + n]
        start = at + HEAD.size + n
        stop = start + sum(lacing)
        page = data[at:stop]
        if version or len(lacing) < n or stop > len(data) or page_checksum(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            at += 1
            continue
        yield {"serial": serial, "number": number, "granule": granule, "flags": flags, "lacing": lacing, "body": data[start:stop]}
        at = stop


def read_ogg(data: bytes) -> dict[int, dict]:
    """Logical streams by serial number: packets, seconds, and what was amiss.

    A packet of which a page is missing is dropped whole and counted in `broken`.
    """
    streams: dict[int, dict] = {}
    for page in read_pages(data):
        s = streams.setdefault(page["serial"], {"packets": [], "granules": [], "pages": 0, "gaps": 0, "broken": 0, "next": 0, "open": None, "ended": False})
        if page["number"] != s["next"]:
            s["gaps"] += 1
            s["broken"] += s["open"] is not None
            s["open"] = None
        resumes = bool(page["flags"] & CONTINUED)
        if not resumes and s["open"] is not None:
            s["broken"], s["open"] = s["broken"] + 1, None
        skip = resumes and s["open"] is None  # the packet's head is lost
        at, part, done = 0, s["open"] or [], len(s["packets"])
        run = 0
        for i, size in enumerate(page["lacing"]):
            run += size
            if size < 255:
                part.append(page["body"][at : at + run])
                if skip:
                    s["broken"], skip = s["broken"] + 1, False
                else:
                    s["packets"].append(b"".join(part))
                    s["granules"].append(None)
                at, run, part = at + run, 0, []
        if page["lacing"] and page["lacing"][-1] == 255:
            s["open"] = None if skip else [*part, page["body"][at:]]
        else:
            s["open"] = None
        if page["granule"] != NO_PACKET_ENDS and len(s["packets"]) > done:
            s["granules"][-1] = page["granule"]
        s["next"], s["pages"] = page["number"] + 1, s["pages"] + 1
        s["ended"] |= bool(page["flags"] & LAST)
    for s in streams.values():
        s["broken"] += s.pop("open") is not None
        s.pop("next")
        head = s["packets"][0] if s["packets"] else b""
        s["rate"] = PCM_HEAD.unpack(head)[4] if head[:4] == b"PCM8" and len(head) == PCM_HEAD.size else None
        last = max((g for g in s["granules"] if g is not None), default=0)
        s["seconds"] = last / s["rate"] if s["rate"] else None
        s["ends"] = last
    return streams


def samples_of(streams: dict[int, dict]) -> bytes:
    return b"".join(p for s in streams.values() if s["rate"] for p in s["packets"][1:])


def features(samples: bytes) -> str:
    """Loudness and shape of 8-bit samples, over blocks so that long ones need little memory."""
    n, total, square, cross, last = len(samples), 0, 0, 0, None
    counts = np.zeros(256, np.int64)
    for at in range(0, n, 1 << 20):
        x = np.frombuffer(samples, np.uint8, min(1 << 20, n - at), at)
        counts += np.bincount(x, minlength=256)
        high = x >= 128
        cross += int((high[1:] != high[:-1]).sum()) + (last is not None and bool(last != high[0]))
        last = high[-1]
    value = np.arange(256) - 128
    total, square = int((counts * value).sum()), int((counts * value * value).sum())
    share = counts[counts > 0] / max(n, 1)
    entropy = float(-(share * np.log2(share)).sum()) + 0.0
    mean = total / max(n, 1)
    return f"n={n};mean={mean:.4f};rms={(square / max(n, 1)) ** 0.5:.4f};cross={cross};entropy={entropy:.4f};peak={int(np.flatnonzero(counts)[-1]) if n else 0}"


def pad(payload: bytes) -> bytes:
    return payload + b"\0" * (-len(payload) % 64 or (0 if payload else 64))


def encode_texts(docs: DataFrame, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """Add media_col: an Ogg container whose 8-bit samples are the padded UTF-8 bytes of text_col.

    A null text counts as empty; the empty payload is 64 zero bytes.  Equal texts give equal containers, whatever
    stands beside them, so repeated rows and ties don't matter.  Very long texts are encoded whole, as many pages; a
    task holds a few texts at a time.  Other columns stay, one called media_col is replaced.  No rows give no rows.
    """

    bounded_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series([write_ogg(pad(t or b""), b"BYTES=%d" % len(t or b"")) for t in texts])

    return docs.withColumn(media_col, encode(F.col(text_col).cast("binary")))


PROBE = (
    "payload binary, payload_sha256 string, payload_bytes long, tail_crc32 long, feature string, media_sha256 string, "
    "seconds double, n_streams int, n_pages long, n_packets long, n_gaps long, n_broken long, comment string"
)


def probe_media(media: Column, with_payload: bool = False) -> Column:
    """What an Ogg container in a binary column holds.

    Null or not a container: no streams, an empty payload, null seconds.  Damaged pages are left out and show as
    gaps and broken packets.  Very long containers are read whole.  Equal containers give equal results.
    """

    @F.pandas_udf(PROBE)
    def probe(blobs: pd.Series) -> pd.DataFrame:
        rows = []
        for blob in blobs:
            blob = blob or b""
            streams = read_ogg(blob)
            payload = samples_of(streams)
            comment = next((s["packets"][1].decode("utf-8", "replace") for s in streams.values() if len(s["packets"]) > 1 and s["packets"][0][:4] == b"NOTE"), None)
            total = {k: sum(s[k] for s in streams.values()) for k in ("pages", "gaps", "broken")}
            rows.append((
                payload if with_payload else None, hashlib.sha256(payload).hexdigest(), len(payload), zlib.crc32(payload[-64:]),
                features(payload), hashlib.sha256(blob).hexdigest(), max((s["seconds"] for s in streams.values() if s["seconds"] is not None), default=None),
                len(streams), total["pages"], sum(len(s["packets"]) for s in streams.values()), total["gaps"], total["broken"], comment,
            ))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in PROBE.split(", ")])

    return probe(media)
