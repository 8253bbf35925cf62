"""Archives: round trips, revisits, broken segments."""

import base64
import hashlib
import os

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimweave.llm import warc
from dimweave.llm.common import written

SCHEMA = "page_id long, url string, html string"


@given(st.binary(max_size=300), st.integers(1, 40))
def test_chunked_framing(payload, size):
    before, warc.CHUNK_BYTES = warc.CHUNK_BYTES, size
    try:
        assert warc.unchunked(warc.chunked(payload)) == payload
    finally:
        warc.CHUNK_BYTES = before


def test_framing_of_others():
    assert warc.unchunked(b"4;name=x\r\nWiki\r\nA\r\n0123456789\r\n0\r\nTrailer: y\r\n\r\n") == b"Wiki0123456789"
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\nabc", b""):
        assert warc.payload_of(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + broken, None, False)[2]


def expected(rows):
    least = {}
    for page, _, html in rows:
        if page is not None:
            least[html or ""] = min(page, least.get(html or "", page))
    count = {h: sum((x or "") == h for _, _, x in rows) for h in {x or "" for _, _, x in rows}}
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = least.get(html or "") if count[html or ""] > 1 else None
        again = first is not None and page != first
        code = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((page, len(raw), code, "revisit" if again else "response", first if again else None))
    return sorted(want, key=str)


def answered(spark, folder):
    rows = warc.op7_warc(spark, folder).collect()
    assert all(r.error is None for r in rows)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_pages(spark, tables, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 300)
    rows = [
        (1, "http://a/", "<p>é"), (2, "http://b/", "<p>é"), (3, None, None), (4, "x\r\ny", ""), (5, "http://c/", "z" * 200_000),
        (6, "http://c/", "z" * 200_000), (None, "http://d/", "<p>é"), (None, "http://d/", "alone"), (7, "http://e/", "twin"), (7, "http://e/", "twin"),
        (0, "http://f/", "\r\n\r\n0\r\n\r\n"),
    ]
    rows += [(10 + i, f"http://h/{i}", "same" if i % 3 else f"page {i} " * (i % 50)) for i in range(120)]
    folder = tables(pages=([(*r, 5) for r in rows], f"{SCHEMA}, payload_bytes int"))
    assert answered(spark, folder) == expected(rows)


def test_no_pages(spark, tables):
    assert answered(spark, tables(pages=([], SCHEMA))) == []


def test_small_payloads_may_be_stored_again(spark, tables, folder):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], SCHEMA)
    found = {r.page_id: r.refers_to for r in warc.revisits(pages, folder, revisit_bytes=3).collect()}
    assert found == {1: None, 2: None, 3: None, 4: 3}


@pytest.mark.parametrize("drop", [1, 2, 99])
def test_broken_segments_are_told(spark, tables, folder, monkeypatch, drop):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 100)
    pages = spark.createDataFrame([(1, "u", "x" * 1000, None), (2, "u", "y" * 500, None)], f"{SCHEMA}, refers_to long")
    records = written(warc.read_archives(warc.write_archives(pages, folder)), f"{folder}/records")
    of_one = F.col("origin") == records.where("page_id = 1").first()["origin"]
    cut = records.where(~(of_one & (F.col("segment") == drop))).withColumn("total", F.when(~of_one | (F.lit(drop) != 99), F.col("total")).otherwise(7))
    found = {r.page_id: r for r in warc.reassemble(cut).collect()}
    assert found[2].error is None and found[2].payload_bytes == 500
    broken = found[None if drop == 1 else 1]
    assert broken.error and broken.payload_bytes is None


def test_members_across_reads(tmp_path):
    records = [r for i in range(300) for r in warc.page_records(i, "http://a/", os.urandom(i * 20), None)]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(records))
    with path.open("rb") as file:
        pages = [warc.parse_record(m)[0]["x-page"] for m in warc.members(file)]
    assert pages == [str(i) for i in range(300)]
    path.write_bytes(b"".join(records)[:-5])
    with path.open("rb") as file, pytest.raises(ValueError, match="cut off"):
        list(warc.members(file))
