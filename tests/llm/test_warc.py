"""WARC archives: exact round trips."""

import gzip
import hashlib
import io

import pytest

from contrail.llm import warc


def test_pages_come_back(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        b = (r.html or "").encode()
        want[r.page_id] = (len(b), hashlib.sha1(b).hexdigest(), r.url)
    largest = {}
    for i, (n, d, _) in want.items():
        largest[d] = max(i, largest.get(d, i))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.url, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages).collect()}
    assert got == {i: (n, d, u, "revisit", largest[d]) if n >= 1000 and largest[d] != i else (n, d, u, "response", None) for i, (n, d, u) in want.items()}


def test_edge_cases(spark):
    big = "é" * 600
    rows = [(1, "http://a", big), (2, None, big), (2, None, big), (3, "http://c\r\nX: y", None), (None, "http://n", big), (5, "u", ""), (6, "u", "x" * 999), (7, "u", "x" * 999),
            (8, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 40000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as size", "2 as digest", "3 as n", "4 as same")
    got = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.archive_round_trip(df).collect()))
    assert got == [(0, 1200, "response", 0), (1, 1200, "revisit", 2), (2, 1200, "response", 0), (2, 1200, "response", 0), (3, 0, "response", 0),
                   (5, 0, "response", 0), (6, 999, "response", 0), (7, 999, "response", 0), (8, len(rows[-1][2]), "response", 0)]
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_normaliser_rewrites_each_record_as_its_own_member():
    records = [warc.record(i, f"http://h/{i}", b"p" * (i * 100_000), hashlib.sha1(b"p" * (i * 100_000)).hexdigest(), i * 100_000, None) for i in range(4)]
    whole = b"".join(records)
    for source in (gzip.compress(whole), gzip.compress(records[0] + records[1][:50]) + gzip.compress(records[1][50:] + records[2]) + gzip.compress(records[3])):
        out, index = io.BytesIO(), io.BytesIO()
        assert warc.normalise_file(io.BytesIO(source), out, index, 6) == 4
        import json
        for r, line in zip(records, index.getvalue().splitlines()):
            e = json.loads(line)
            assert gzip.decompress(out.getvalue()[e["offset"]:e["offset"] + e["length"]]) == r
        assert gzip.decompress(out.getvalue()) == whole


def test_cut_stream_is_an_error():
    whole = gzip.compress(warc.record(1, "u", bytes(range(256)) * 4000, "00" * 20, 1024000, None))
    with pytest.raises(OSError):
        warc.normalise_file(io.BytesIO(whole[:-40]), io.BytesIO(), io.BytesIO(), 6)
