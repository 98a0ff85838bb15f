import base64
import gzip
import hashlib

import pytest

from emberline.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_round_trip(spark, tmp_path):
    hard = "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb"
    rows = [(5, "http://a/ b", hard), (3, "http://c/é", hard), (4, None, None), (9, "u", ""), (7, "v", "é" * 300000), (7, "v", "é" * 300000), (8, "w", "é" * 300000), (None, "n", "only"), (1, "z", "\n"), (None, "m", "\n")]
    warc.write_warc(pages(spark, rows), f"file://{tmp_path}/w", id_col="page_id")
    got = warc.resolve(warc.read_warc(spark, f"file://{tmp_path}/w")).collect()
    assert len(got) == len(rows)
    want = []
    for i, _, t in rows:
        body = (t or "").encode()
        ids = [j for j, _, u in rows if (u or "") == (t or "") and j is not None]
        first = min(ids) if ids else None
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if i == first else "revisit", None if i == first else first, body))
    key = lambda r: (str(r[0]), r[2])
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got], key=key) == sorted(want, key=key)


def test_small_payloads_are_responses(spark, tmp_path):
    warc.write_warc(pages(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")]), f"file://{tmp_path}/w", min_bytes=3)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.resolve(warc.read_warc(spark, f"file://{tmp_path}/w")).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_empty(spark, tmp_path):
    warc.write_warc(pages(spark, []), f"file://{tmp_path}/w")
    assert warc.read_warc(spark, f"file://{tmp_path}/w").count() == 0


def test_records_by_length():
    one = b"WARC/1.1\r\nContent-Length: 3\r\n\r\na\r\n\r\n\r\n"
    assert [b for _, b in warc.records(gzip.compress(one) + gzip.compress(one * 2))] == [b"a\r\n"] * 3
    with pytest.raises(ValueError, match="ends within"):
        list(warc.records(gzip.compress(one[:-5])))
