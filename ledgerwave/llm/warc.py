"""WARC archives: one gzip member per record, written by Spark and read back in sequence."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwave.llm.common import text_of, written
from ledgerwave.session import fresh_path

#: Payloads shorter than this are never told by reference; an archive is closed at so many bytes.
LEAST_REVISIT, ARCHIVE_BYTES = 1000, 8 << 20
DATE = "2000-01-01T00:00:00Z"
READ = 1 << 16


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header alone, which still tells the payload's length."""
    target = urllib.parse.quote(url or f"urn:page:{page_id}", safe=":/?#[]@!$&'()*+,;=%~")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _archives(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_, held = [], 0

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(open_)], pa.binary())], ["archive"])

    for part in parts:
        columns = [part.column(n) for n in ("page_id", "url", "html", "refers_to", "revisit")]
        for i in range(part.num_rows):
            page_id, url, html, refers_to, revisit = (c[i].as_py() for c in columns)
            payload = html.encode()
            open_.append(record(page_id, url, payload, hashlib.sha1(payload).digest(), refers_to, revisit))
            held += len(open_[-1])
            if held >= ARCHIVE_BYTES:
                yield close()
                open_, held = [], 0
    if open_:
        yield close()


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT) -> None:
    """Pages (page_id, url, html) as WARC files under ``path``.

    Of pages whose payloads are equal and have at least ``least`` bytes, the one with the largest page_id is a
    response and the others revisit it. A null html is an empty payload, a null url is named after the page. Rows that
    repeat the largest page_id are all responses, as are pages of a payload for which no page_id is known; a null
    page_id is never the largest. Other columns are not read.

    Spark's own writer puts every archive in a file, so any file system Spark writes to will do. It ends a file with
    one zero byte, which gzip readers take for padding.
    """
    own = pages.select("page_id", F.col("url").cast("string").alias("url"), text_of("html").alias("html")).withColumns(
        {"sha": F.sha2(F.col("html").cast("binary"), 256), "bytes": F.octet_length("html")}
    )
    # Written first, so that Spark knows its size before it chooses the join.
    copies = written(
        own.filter(F.col("bytes") >= least)
        .groupBy("sha")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("largest"))
        .filter((F.col("n") > 1) & F.col("largest").isNotNull())
        .select("sha", "largest"),
        "payloads",
    )
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull(), F.lit(False))
    (
        own.join(copies, "sha", "left")
        .select("page_id", "url", "html", F.col("largest").alias("refers_to"), revisit.alias("revisit"))
        .mapInArrow(_archives, "archive binary")
        .select(F.col("archive").cast("string").alias("value"))
        .write.option("lineSep", "\0")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


class BrokenArchive(ValueError):
    """A record that is cut off, wrongly framed or of another digest than it says."""


class _Stream:
    """The bytes of one gzip member after another, decompressed as they are asked for."""

    def __init__(self, content: bytes) -> None:
        self.content, self.at, self.held, self.member = memoryview(content), 0, b"", None

    def more(self) -> bool:
        """Whether another member begins here."""
        while self.at < len(self.content) and self.content[self.at] == 0:
            self.at += 1
        if self.at == len(self.content):
            return False
        self.member, self.held = zlib.decompressobj(31), b""
        return True

    def _fill(self) -> bool:
        if self.member.eof:
            return False
        fed = self.member.unconsumed_tail or bytes(self.content[self.at : self.at + READ])
        if not fed:
            raise BrokenArchive("the archive ends inside a member")
        if not self.member.unconsumed_tail:
            self.at += len(fed)
        self.held += self.member.decompress(fed, READ)
        if self.member.eof:
            self.at -= len(self.member.unused_data)
        return True

    def until(self, mark: bytes) -> bytes:
        while (end := self.held.find(mark)) < 0:
            if not self._fill():
                raise BrokenArchive("a header without an end")
        found, self.held = self.held[:end], self.held[end + len(mark) :]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._fill():
                raise BrokenArchive("a block shorter than its content length")
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            if piece:
                yield piece

    def finish(self) -> None:
        while self._fill():
            pass
        if self.held != b"\r\n\r\n":
            raise BrokenArchive("a record that does not end after its block")


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines)}


def _hex(digest: str) -> str:
    return base64.b32decode(digest.removeprefix("sha1:")).hex()


def read_records(content: bytes) -> Iterator[tuple[dict[str, str], int, str, bytes | None]]:
    """Every record of an archive in its order: fields, the payload's length and SHA-1, and the payload if it is there."""
    stream = _Stream(content)
    while stream.more():
        version, *lines = stream.until(b"\r\n\r\n").split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise BrokenArchive("not a WARC record")
        fields = _fields(lines)
        whole, payload = hashlib.sha1(), hashlib.sha1()
        http, pieces = b"", None
        for piece in stream.take(int(fields["content-length"])):
            whole.update(piece)
            if pieces is None:
                http += piece
                if (end := http.find(b"\r\n\r\n")) < 0:
                    continue
                piece, pieces = http[end + 4 :], []
                http = http[:end]
            payload.update(piece)
            pieces.append(piece)
        stream.finish()
        if whole.hexdigest() != _hex(fields["warc-block-digest"]):
            raise BrokenArchive(f"{fields['warc-record-id']}: other block than its digest says")
        said, length = _hex(fields["warc-payload-digest"]), int(_fields(http.split(b"\r\n")[1:])["content-length"])
        if fields["warc-type"] == "revisit":
            yield fields, length, said, None
            continue
        body = b"".join(pieces or [])
        if payload.hexdigest() != said or len(body) != length:
            raise BrokenArchive(f"{fields['warc-record-id']}: other payload than its digest says")
        yield fields, length, said, body


_PAGE = re.compile(r"<urn:page:(-?\d+|null)>")


def _page(name: str | None) -> int | None:
    found = _PAGE.fullmatch(name or "<urn:page:null>")
    return None if found is None or found[1] == "null" else int(found[1])


READ_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("html", pa.string()),
    ]
)


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for content in part.column("content"):
            rows, held = [], 0
            for fields, length, digest, body in read_records(content.as_py()):
                rows.append(
                    (
                        _page(fields["warc-record-id"]),
                        fields["warc-target-uri"],
                        length,
                        digest,
                        fields["warc-type"],
                        _page(fields.get("warc-refers-to")),
                        None if body is None else body.decode("utf-8"),
                    )
                )
                held += len(body or b"")
                if held > ARCHIVE_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(v, t) for v, t in zip(zip(*rows), READ_SCHEMA.types)]
    return pa.RecordBatch.from_arrays(arrays, schema=READ_SCHEMA)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``; a broken one stops the job. A revisit has no html of its own."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select("content")
        .mapInArrow(
            _rows,
            "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long, html string",
        )
    )


def through_archives(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` written as archives in the shared folder and read back. An empty table gives no records."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, least)
    return read_archives(pages.sparkSession, path)
