import hashlib
import os

import pytest

from tradelake.llm import warc as W
from tradelake.session import new_scratch_path

PAGES = "page_id long, url string, html string, HTML_note string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n") for r in rows], PAGES)


BIG = "<p>é😀 text\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n</p>" * 900
SAME = "<html>" + "x" * 200


def test_round_trip(spark):
    rows = [(5, "http://a/ b\r\nX: y", SAME), (3, "http://b", SAME), (9, None, SAME), (None, "http://n", SAME), (1, "u", None),
            (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (7, "u", BIG), (8, "u", BIG), (7, "u", BIG), (10, "u", "y" * 99),
            (11, "u", "y" * 99), (12, "u", "z" * 100), (13, "u", "z" * 100)]
    for size in (37, 1000, 1 << 20):
        path = new_scratch_path(spark, "warc-test")
        W.write_archives(frame(spark, rows), path, segment_bytes=size, records_per_file=50)
        got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                      for r in W.read_pages(spark, path).collect()), key=str)
        first = {SAME: 3, BIG: 7, "z" * 100: 12}
        expected = []
        for i, _, html in rows:
            data = (html or "").encode()
            to = first.get(html)
            revisit = to is not None and i != to
            expected.append((i or 0, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
        assert got == sorted(expected, key=str)


def test_payloads_come_back_byte_by_byte(spark):
    path = new_scratch_path(spark, "warc-test")
    W.write_archives(frame(spark, [(1, "u", BIG), (2, "u", "a")]), path, segment_bytes=513)
    found = W.decoded(W.reassemble(W.read_records(spark, path)), with_payload=True).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in found} == {"1": BIG, "2": "a"}


def test_gaps_and_damage_are_errors(spark):
    path = new_scratch_path(spark, "warc-test")
    W.write_archives(frame(spark, [(1, "u", BIG)]), path, segment_bytes=5000)
    records = W.read_records(spark, path)
    assert records.count() > 3
    for broken in (records.where("segment is null or segment <> 2"), records.where("total is null")):
        with pytest.raises(Exception, match="segments missing"):
            W.reassemble(broken).collect()
    with pytest.raises(ValueError):
        W.dechunked(b"5\r\nabc\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(W.parse(W.record([("WARC-Type", "response")], b"abc") + b"\r\n??"))
    assert W.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"


def test_files_are_plain_archives(spark):
    path = new_scratch_path(spark, "warc-test")
    W.write_archives(frame(spark, [(1, "u", "abc")]), path)
    files = [f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-")]
    (fields, block), = [r for f in files for r in W.parse(open(f, "rb").read())]
    assert fields["warc-type"] == "response" and W.http_payload(block) == b"abc"


def test_empty(spark):
    path = new_scratch_path(spark, "warc-test")
    W.write_archives(frame(spark, []), path)
    assert W.read_pages(spark, path).count() == 0
