"""WARC: round trip, framing, digests, revisits."""

import base64
import gzip
import hashlib
import io

import pytest

from noticeboard.llm import warc

PAGES = "page_id long, url string, html string, payload_bytes int, refers_to long"


def _pages(spark, *rows):
    return spark.createDataFrame([(*r, 7, 8) for r in rows], PAGES)


def _want(rows):
    keep = {}
    for i, _, html in rows:
        if i is not None:
            keep[html or ""] = max(i, keep.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = keep[html or ""] if i is not None and keep[html or ""] != i else None
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_archive(spark):
    rows = [(1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (3, None, None), (4, "http://c/x y\r\nz", ""), (5, "", "é" * 200_000), (5, "", "é" * 200_000), (None, "u", "<p>same</p>"), (6, "u", "line\r\n\r\nline\r\n\r\n"), (7, "http://b/", "<p>same</p>")]
    got = warc.archive(_pages(spark, *rows)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == _want(rows)


def test_no_pages(spark):
    assert warc.archive(_pages(spark)).count() == 0


def test_small_payloads_may_be_responses_all(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    got = {r.page_id: r.refers_to for r in warc.archive(_pages(spark, *rows), least_bytes=5).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_one_member_per_record_and_many_archives(spark, tmp_path, monkeypatch):
    a, b = warc.record(1, "http://x/", b"one", None, "2000-01-01T00:00:00Z"), warc.record(2, None, b"one", 1, "2000-01-01T00:00:00Z")
    assert gzip.decompress(a).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and gzip.decompress(a).endswith(b"one\r\n\r\n")
    assert b"WARC-Refers-To: <urn:page:1>" in gzip.decompress(b)
    read = list(warc.read_archive(io.BytesIO(a + b)))
    assert [(r[0], r[1], r[2], r[3], r[6]) for r in read] == [(1, "http://x/", "response", None, b"one"), (2, None, "revisit", 1, None)]


def test_payloads_come_back(spark, tmp_path):
    pages = _pages(spark, *[(i, "u", f"<p>{i}</p>" * 50) for i in range(40)])
    folder = f"file://{tmp_path}/warc"
    files = warc.write_archives(warc.with_revisits(pages.drop("refers_to")), folder)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(files, folder).collect()}
    assert got == {i: f"<p>{i}</p>" * 50 for i in range(40)}


def _tampered(data: bytes, old: bytes, new: bytes) -> io.BytesIO:
    return io.BytesIO(gzip.compress(gzip.decompress(data).replace(old, new)))


@pytest.mark.parametrize("old,new", [(b"one\r\n\r\n", b"two\r\n\r\n"), (b"one\r\n\r\n", b"one\r\n"), (b"WARC/1.1", b"WARC/9.9"), (b"one\r\n\r\n", b"one\r\n\r\nmore")])
def test_damage_fails(old, new):
    with pytest.raises(ValueError):
        list(warc.read_archive(_tampered(warc.record(1, "u", b"one", None, "d"), old, new)))


def test_a_cut_archive_fails():
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(warc.record(1, "u", b"one" * 1000, None, "d")[:-12])))
