import hashlib
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from tallyforge.llm.warc import frame_spans, page_of, read_record, read_warc, record_id, seek_table, warc_index, write_warc


@pytest.fixture(scope="module")
def pages(spark):
    r = random.Random(6)
    same = "<p>" + "x" * 200
    rows = [(i, f"http://h/{i}", "<html>" + "".join(chr(r.randrange(97, 123)) for _ in range(r.randrange(3000)))) for i in range(60)]
    rows += [(100 + i, f"http://h/d{i}", same) for i in range(30)] + [(50, "http://h/x y\n", same), (50, "http://h/again", same)]
    rows += [(201, None, "short"), (202, "u", "short"), (203, "u", None), (204, "u", ""), (None, "u", same), (None, None, None), (205, "ü", "é" * 50), (206, "ü", "é" * 50)]
    return spark.createDataFrame([(*x, "clash") for x in rows], "page_id long, url string, html string, digest string")


def brute(rows):
    first = {}
    for r in rows:
        h = (r.html or "").encode()
        if len(h) >= 100 and r.page_id is not None:
            first[h] = min(first.get(h, r.page_id), r.page_id)
    out = []
    for r in rows:
        h = (r.html or "").encode()
        again = r.page_id is not None and first.get(h, r.page_id) != r.page_id
        out.append((r.page_id, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("frame,bundle", [(1, 1), (3000, 9000), (1 << 18, 1 << 23)])
def test_round_trip(pages, frame, bundle):
    written = write_warc(pages, frame_bytes=frame, bundle_bytes=bundle)
    got = read_warc(written)
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()]
    assert sorted(rows, key=str) == brute(pages.collect()) and got.filter("not intact").count() == 0


def test_index_reads_single_records(pages):
    written = write_warc(pages, frame_bytes=3000, bundle_bytes=9000)
    data = {r.bundle: bytes(r.data) for r in written.collect()}
    html = {r.page_id: r.html for r in pages.collect()}
    rows = [r for r in warc_index(written).collect() if page_of(r.record_id) is not None and page_of(r.record_id) < 60 and page_of(r.record_id) != 50]
    assert len(rows) == 59
    for r in rows:
        record = read_record(data[r.bundle], r.frame, r.offset, r.length)
        assert record["fields"]["warc-record-id"] == r.record_id and record["payload"].decode() == html[page_of(r.record_id)]


def test_bundles_are_plain_zstandard(pages):
    for r in write_warc(pages, frame_bytes=3000, bundle_bytes=9000).collect():
        data = bytes(r.data)
        plain = b"".join(zstandard.ZstdDecompressor().decompress(data[a : a + c], max_output_size=max(d, 1)) for a, c, d in frame_spans(data))
        assert plain.startswith(b"WARC/1.1") and plain.count(b"WARC/1.1\r\n") == len(r.records)


def test_damaged_footers_are_refused():
    with pytest.raises(ValueError):
        frame_spans(b"x" * 40)
    assert frame_spans(seek_table([])) == [] and page_of(record_id(7)) == 7 and page_of(record_id(None)) is None


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_warc(write_warc(none)).count() == 0
    assert write_warc(none).select(F.count("*")).first()[0] == 0
