"""WARC: round trips, byte ranges of any size, damaged archives, revisits."""

import gzip
import hashlib

import pytest

from starmart.llm import warc
from starmart.session import scratch_path

SCHEMA = "page_id long, url string, html string, sha1 string, length int"


def member(record_id="1", url="http://a/b", kind="response", refers_to=None, payload=b"<p>hi</p>"):
    return gzip.compress(warc.encode_record(record_id, url, kind, refers_to, len(payload),
                                            hashlib.sha1(payload).hexdigest(), payload, "2024-01-01T00:00:00Z"),
                         mtime=0)


def reader(data):
    return lambda position, size: data[position:position + size]


def test_every_record_belongs_to_exactly_one_range_however_the_file_is_cut():
    data = b"".join(member(str(i), payload=bytes([65 + i % 26]) * (i * 7 % 300)) for i in range(40))
    want = [str(i) for i in range(40)]
    for size in (1, 2, 7, 50, 333, 10_000):
        got = [r["record_id"] for at in range(0, len(data), size)
               for r in warc.records_in(reader(data), at, min(len(data), at + size))]
        assert got == want


def test_bytes_that_are_no_record_are_passed_over():
    fake = gzip.compress(b"not a record", mtime=0) + warc.MAGIC + b"\x00garbage" + warc.MAGIC + b"\xff" * 40
    cut = member("cut", payload=b"x" * 5000)[:-9]
    bad = bytearray(member("bad", payload=b"y" * 300))
    bad[-6] ^= 0xFF  # the CRC
    data = fake + member("1") + cut + bytes(bad) + member("2") + fake + b"\x1f\x8b"
    for size in (13, 100, len(data)):
        got = [r["record_id"] for at in range(0, len(data), size)
               for r in warc.records_in(reader(data), at, min(len(data), at + size))]
        assert got == ["1", "2"]


def test_a_record_longer_than_a_range_and_than_a_read():
    payload = bytes(range(256)) * 4000
    data = member("a") + member("big", payload=payload) + member("z")
    got = [r for at in range(0, len(data), 1000) for r in warc.records_in(reader(data), at, at + 1000)]
    assert [r["record_id"] for r in got] == ["a", "big", "z"]
    assert got[1]["payload"] == payload and got[1]["digest_ok"]


def pages():
    long_a, long_b = "<html>" + "a" * 2000, "é" * 500  # the second: 1000 bytes
    return [(1, "http://x/1", long_a, None, 1), (2, "http://x/2?q=ü v\r\nX: 1", long_a, "s", 1),
            (3, None, "short", None, 1), (4, "http://x/4", "short", None, 1), (9, "http://x/9", long_a, None, 1),
            (5, "u", None, None, 1), (6, "u", "", None, 1), (7, "u", long_b, None, 1), (8, "u", long_b, None, 1),
            (None, "u", long_b, None, 1), (10, "u", "é" * 499 + "x", None, 1), (9, "again", long_a, None, 1),
            (11, "u", "line\r\n\r\nline\x00" * 400, None, 1)]


def want(rows):
    out, best = [], {}
    for page_id, _, html, *_ in rows:
        if len((html or "").encode()) >= 1000:
            best[html] = max([x for x in (best.get(html), page_id) if x is not None], default=None)
    for page_id, _, html, *_ in rows:
        body = (html or "").encode()
        keep = best.get(html)
        revisit = keep is not None and page_id != keep
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response",
                    keep if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [64, 1 << 20])
def test_round_trip(spark, split):
    rows = pages()
    folder = scratch_path(spark, "warc-test")
    files = warc.write_archives(spark.createDataFrame(rows, SCHEMA), folder, roll_bytes=900)
    assert files.agg({"records": "sum"}).first()[0] == len(rows)
    listed = {(r.path.split("/")[-1], r.length) for r in warc.archive_files(spark, folder).collect()}
    assert listed == {(r.path.split("/")[-1], r.length) for r in files.collect()}
    got = warc.read_archives(files, split_bytes=split).collect()
    key = [(None if r.record_id is None else int(r.record_id), r.payload_bytes, r.payload_digest, r.record_type,
            None if r.refers_to is None else int(r.refers_to)) for r in got]
    assert sorted(key, key=str) == want(rows)
    texts = {(r.record_id, bytes(r.payload)) for r in got if r.record_type == "response"}
    assert ("11", pages()[-1][2].encode()) in texts
    assert all(r.digest_ok for r in got)
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    urls = {r.record_id: r.url for r in got}
    assert urls["3"] is None and urls["2"] == "http://x/2?q=%C3%BC%20v%0D%0AX:%201"


def test_archives_are_plain_gzip_and_revisits_carry_no_payload(spark):
    folder = scratch_path(spark, "warc-plain")
    files = warc.write_archives(spark.createDataFrame(pages(), SCHEMA).coalesce(1), folder).collect()
    data = b""
    for f in files:
        system, inside = warc._open(f.path)
        with system.open_input_stream(inside, compression=None) as stream:
            data += gzip.decompress(stream.read())
    assert data.count(b"WARC/1.1\r\n") == len(pages())
    assert data.count(b"a" * 2000) == 2  # two rows share the largest id


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
