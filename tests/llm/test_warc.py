"""WARC files: what is written can be read, by this reader and by gzip, and broken files are told."""

import gzip
import hashlib

import pytest
from helpers import with_clashes

from ledgerwave.llm import warc
from ledgerwave.session import fresh_path

PAGES = "page_id long, url string, html string"


def digest(text):
    return hashlib.sha1((text or "").encode()).hexdigest()


def test_revisits(spark):
    big, other = "é" * 500, "x" * 999
    rows = [
        (1, "http://a/1", big), (7, None, big), (3, "http://a/\r\n3 é", big), (7, "http://a/7", big), (4, "u", other), (5, "u", other),
        (6, "u", None), (8, "u", ""), (None, "u", big), (None, "u", "z" * 2000), (None, "u", "z" * 2000),
        (9, "u", "a\r\n\r\nWARC/1.1\r\n\0" + "y" * 300_000),
    ]
    pages = with_clashes(spark.createDataFrame(rows, PAGES), "sha", "bytes", "revisit", "refers_to", "largest", "n")
    found = warc.through_archives(pages).collect()
    got = sorted((r["page_id"] is None, r["page_id"] or 0, r["payload_digest"], r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in found)
    def kind(page, text):
        if page == 7 or text != big:
            return "response", 0
        return "revisit", 7
    want = sorted((p is None, p or 0, digest(t), len((t or "").encode()), *kind(p, t)) for p, _, t in rows)
    assert got == want
    assert {r["html"] for r in found if r["page_id"] == 9} == {rows[-1][2]}
    assert all(r["html"] is None for r in found if r["record_type"] == "revisit")


def test_files_are_plain_gzip(spark, sample_dir):
    pages = spark.read.parquet(f"{sample_dir}/pages.parquet")
    path = fresh_path(spark, "warc-test")
    warc.write_archives(pages, path)
    files = spark.read.format("binaryFile").load(path).collect()
    whole = b"".join(gzip.decompress(f["content"]) for f in files)
    assert whole.count(b"WARC-Type: ") >= pages.count()
    found = warc.read_archives(spark, path)
    assert {r["page_id"]: r["html"] for r in found.collect()} == {r["page_id"]: r["html"] for r in pages.collect()}


def one(payload=b"p" * 5000):
    return warc.record(1, "http://a", payload, hashlib.sha1(payload).digest(), None, False)


def test_many_archives(spark, monkeypatch):
    many = one() + b"\0\0" + one(b"") + one(bytes(range(128)) * 4000)
    assert [(n, len(b)) for _, n, _, b in warc.read_records(many)] == [(5000, 5000), (0, 0), (512_000, 512_000)]
    assert list(warc.read_records(b"")) == [] and list(warc.read_records(b"\0\0")) == []


def test_broken_archives():
    whole = one()
    with pytest.raises(warc.BrokenArchive):
        list(warc.read_records(whole[:-30]))
    raw = gzip.decompress(whole)
    for broken in (raw.replace(b"ppp", b"pqp", 1), raw[:-4] + b"xx\r\n", raw.replace(b"WARC/1.1", b"HTTP/1.1")):
        with pytest.raises(warc.BrokenArchive):
            list(warc.read_records(gzip.compress(broken)))


def test_empty(spark):
    assert warc.through_archives(spark.createDataFrame([], PAGES)).count() == 0
