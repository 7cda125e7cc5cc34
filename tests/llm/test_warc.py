import hashlib
import re

import pytest

from papervein.llm import warc
from papervein.llm.queries import op7_warc

SF = "/root/testdata/sf0.001"


def expected_of(pages):
    payloads = [(p, (h or "").encode()) for p, h in pages]
    holder = {}
    for p, b in payloads:
        if len(b) >= 1000 and p is not None:
            holder[b] = max(p, holder.get(b, p))
    out = []
    for p, b in payloads:
        refers = holder.get(b) if holder.get(b) != p else None
        out.append((str(p), len(b), hashlib.sha1(b).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def rows_of(df):
    rows = df.collect()
    assert all(r.valid for r in rows)
    return sorted(((str(r.page_id), *tuple(r)[1:5]) for r in rows), key=str)


PAGES = [
    (1, None), (2, ""), (3, "x" * 999), (4, "x" * 999), (5, "y" * 1000), (6, "y" * 1000), (7, "é" * 500), (8, "é" * 500),
    (8, "é" * 500), (9, "a\r\n\r\nWARC/1.1\r\n\r\n" * 100), (10, "\r\n\r\n"), (-3, "y" * 1000), (None, "y" * 1000),
    (None, "z" * 2000), (None, "z" * 2000), (12, "long " * 50_000), (13, "long " * 50_000),
]


@pytest.mark.parametrize("chunk,archive", [(256 << 10, 64 << 20), (1000, 5000), (7, 300)])
def test_round_trip(spark, monkeypatch, chunk, archive):
    monkeypatch.setattr(warc, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive)
    pages = PAGES if chunk > 100 else PAGES[:-2]
    df = spark.createDataFrame([(p, f"http://h/{p}\r\nX: y" if p != 2 else None, h, "c") for p, h in pages],
                               "page_id long, url string, html string, payload string").repartition(3)
    assert rows_of(warc.round_trip(df)) == expected_of(pages)


def test_chunks(spark, monkeypatch):
    """Chunks put end to end are WARC records; payload rows carry the digest so far."""
    monkeypatch.setattr(warc, "CHUNK_BYTES", 1000)
    df = spark.createDataFrame([(p, "http://h/", h) for p, h in PAGES], "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(warc.plan_records(df)).cache()
    assert archives.selectExpr("max(length(data))").first()[0] <= 1000
    whole = b"".join(r.data for r in archives.orderBy("archive", "chunk_no").collect())
    at = count = 0
    while at < len(whole):
        head = whole[at : whole.index(b"\r\n\r\n", at) + 4]
        assert head.startswith(b"WARC/1.1\r\n")
        at += len(head) + int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert whole[at : at + 4] == b"\r\n\r\n"
        at, count = at + 4, count + 1
    assert count == len(PAGES)
    texts = {p: (h or "").encode() for p, h in PAGES if p is not None}
    payloads = {}
    for r in warc.read_archives(archives).orderBy("record_id", "chunk_no").collect():
        if r.record_type == "response":
            own = payloads.setdefault((r.record_id, r.page_id), bytearray())
            own += r.data
            assert len(r.data) <= 1000 and r.payload_bytes == len(own)
            assert r.payload_digest == hashlib.sha1(own).hexdigest()
    for (_, page), data in payloads.items():
        assert page is None or bytes(data) == texts[page]


def test_damage_is_seen(spark):
    df = spark.createDataFrame([(1, "u", "some text"), (2, "u", "other")], "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(warc.plan_records(df)).selectExpr(
        "archive", "chunk_no", "encode(replace(decode(data, 'UTF-8'), 'some text', 'same text'), 'UTF-8') AS data"
    )
    assert {r.page_id: r.valid for r in warc.read_archives(archives).where("last").collect()} == {1: False, 2: True}


def test_query(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert rows_of(op7_warc(spark, SF)) == expected_of(pages)


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
