import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.llm.ogg import FIRST, LAST, encode_texts, features, pad, page_checksum, probe_media, read_ogg, read_pages, samples_of, write_ogg


def slow_checksum(data):
    r = 0
    for b in data:
        r ^= b << 24
        for _ in range(8):
            r = ((r << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if r & 0x80000000 else (r << 1) & 0xFFFFFFFF
    return r


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=400))
def test_checksum(data):
    assert page_checksum(data) == slow_checksum(data)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 254, 255, 256, 4079, 4080, 4081, 65_025, 200_000])
def test_round_trip(n):
    payload = pad(random.Random(n).randbytes(n))
    streams = read_ogg(write_ogg(payload, b"note" * 300))
    assert samples_of(streams) == payload and len(payload) % 64 == 0 and payload
    audio, note = streams[1], streams[2]
    assert note["packets"][1] == b"note" * 300
    assert audio["seconds"] == len(payload) / 8000 and audio["ended"] and not audio["gaps"] and not audio["broken"]


def test_pages_are_well_formed():
    pages = list(read_pages(write_ogg(pad(bytes(300_000)), b"x" * 70_000)))
    for serial in (1, 2):
        own = [p for p in pages if p["serial"] == serial]
        assert [p["number"] for p in own] == list(range(len(own)))
        assert own[0]["flags"] & FIRST and own[-1]["flags"] & LAST and sum(bool(p["flags"] & LAST) for p in own) == 1
    assert all(p["granule"] == -1 or p["granule"] >= 0 for p in pages)


def test_damage_is_noticed_and_skipped():
    payload = pad(random.Random(1).randbytes(300_000))
    whole = bytearray(write_ogg(payload, b"c" * 70_000))
    whole[150_000] ^= 1
    streams = read_ogg(b"junk OggS" + bytes(whole) + b"OggS")
    assert sum(s["gaps"] for s in streams.values()) == 1 and len(samples_of(streams)) < len(payload)
    assert read_ogg(b"") == {} == read_ogg(b"no container at all")


def test_operator(spark, awkward, nothing):
    out = encode_texts(awkward)
    assert out.columns == [*awkward.columns, "media"] and out.count() == awkward.count()
    rows = out.select("doc_id", "text", "media", probe_media(F.col("media"), True).alias("m")).collect()
    for r in rows:
        payload = pad((r.text or "").encode())
        assert bytes(r.m.payload) == payload and r.m.payload_sha256 == hashlib.sha256(payload).hexdigest()
        assert r.m.tail_crc32 == zlib.crc32(payload[-64:]) and r.m.payload_bytes == len(payload) and r.m.feature == features(payload)
        assert r.m.media_sha256 == hashlib.sha256(bytes(r.media)).hexdigest() and r.m.n_streams == 2 and not r.m.n_gaps
        assert r.m.comment == f"BYTES={len((r.text or '').encode())}"
    assert encode_texts(nothing).count() == 0
    bad = spark.createDataFrame([(None,), (b"zzz",)], "media binary").select(probe_media(F.col("media")).alias("m")).collect()
    assert all(r.m.payload_bytes == 0 and r.m.n_streams == 0 and r.m.seconds is None for r in bad)
