"""Web pages as WARC archives: one gzip member per record, read back record by record.

Every page is one record. Of pages with equal payloads one is a response, the others are revisits
that refer to it and hold no payload. The reader goes through an archive once: it inflates member
by member in small steps, takes as many bytes as Content-Length says and verifies the digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_many_facts
from ..session import new_folder, written
from .common import SLICE, arrow_schema, filesystem, record_batch

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive is closed and the next begun once it holds so many bytes.
ARCHIVE_BYTES = 64 << 20
_STEP = 1 << 16


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(value: str) -> str:
    """A header value: one line, blanks and line ends escaped."""
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_field(url)}"] if url is not None else []),
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{digest32(payload)}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


class _Members:
    """The bytes of an archive, inflated in small steps; a new gzip member begins a new record."""

    def __init__(self, stream) -> None:
        self.stream, self.packed, self.plain, self.inflate = stream, b"", bytearray(), None

    def begin(self) -> bool:
        """Go to the next member; False at the end of the archive."""
        if self.inflate:
            while not self.inflate.eof:
                self._more()
            if self.plain:
                raise ValueError("a record is longer than its length says")
            self.packed = self.inflate.unused_data
        self.packed = self.packed or self.stream.read(_STEP)
        self.inflate = zlib.decompressobj(31) if self.packed else None
        return self.inflate is not None

    def _more(self) -> None:
        data = self.packed or self.inflate.unconsumed_tail or self.stream.read(_STEP)
        self.packed = b""
        if not data:
            raise ValueError("an archive ends inside a record")
        self.plain += self.inflate.decompress(data, _STEP)

    def take(self, n: int) -> bytes:
        while len(self.plain) < n:
            if self.inflate.eof:
                raise ValueError("a record is shorter than its length says")
            self._more()
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out

    def lines(self) -> list[str]:
        """Header lines up to the empty one."""
        seen = 0
        while (end := self.plain.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.plain)
            if self.inflate.eof:
                raise ValueError("a record without the end of its header")
            self._more()
        return self.take(end + 4)[:-4].decode().split("\r\n")


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_archive(stream) -> Iterator[tuple[int | None, str | None, str, int | None, int, str, bytes | None]]:
    """Records of one archive: page_id, url, type, refers_to, payload bytes, payload digest, and the
    payload of a response. A wrong length or digest fails."""
    members = _Members(stream)
    while members.begin():
        version, *rest = members.lines()
        fields = _fields(rest)
        block = members.take(int(fields["content-length"]))
        if version != "WARC/1.1" or members.take(4) != b"\r\n\r\n":
            raise ValueError("not a whole WARC/1.1 record")
        if fields["warc-block-digest"] != f"sha1:{digest32(block)}":
            raise ValueError("block digest differs")
        http, _, payload = block.partition(b"\r\n\r\n")
        size, digest = int(_fields(http.decode().split("\r\n")[1:])["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
        kind = fields["warc-type"]
        if kind == "response" and (size != len(payload) or digest != digest32(payload)):
            raise ValueError("payload digest differs")
        refers = _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None
        yield _page(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, refers, size, digest, payload if kind == "response" else None


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: null for a response, else the largest page_id with an equal payload.

    Equal payloads have equal SHA-1 and length. The digests of all pages are counted without the
    pages themselves; only rows that are revisits come back to the pages, joined by page.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.withColumn("__sha1", F.sha1(body)).withColumn("__bytes", F.octet_length(body))
    narrow = keyed.filter(F.col("__bytes") >= least_bytes).select("page_id", "__sha1", "__bytes")
    groups = narrow.groupBy("__sha1", "__bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisits = join_many_facts(narrow, groups, ["__sha1", "__bytes"]).filter("page_id != refers_to").select("page_id", "__sha1", "refers_to").distinct()
    return keyed.join(revisits.hint("shuffle_hash"), ["page_id", "__sha1"], "left").drop("__sha1", "__bytes")


_FILES = "file string, records long"


def write_archives(pages: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write rows ``page_id``, ``url``, ``html``, ``refers_to`` to archives; returns their names as Spark
    commits them, so archives of lost attempts are never read."""
    arrow = arrow_schema(_FILES)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        system.create_dir(path, recursive=True)
        part = TaskContext.get().partitionId()
        out, name, size, count = None, "", 0, 0
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    for row in batch.slice(at, SLICE).to_pylist():
                        if out is None:
                            name, size, count = f"{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                            out = system.open_output_stream(f"{path}/{name}", compression=None)
                        data = record(row["page_id"], row["url"], (row["html"] or "").encode(), row["refers_to"], date)
                        out.write(data)
                        size, count = size + len(data), count + 1
                        if size >= ARCHIVE_BYTES:
                            out.close()
                            out = None
                            yield record_batch([(name, count)], arrow)
        finally:
            if out:
                out.close()
        if out:
            yield record_batch([(name, count)], arrow)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), F.col("refers_to").cast("long").alias("refers_to"))
    return written(rows.mapInArrow(write, _FILES), "archives")


def read_archives(files: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the named archives: ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` and, if asked for, ``payload`` (null for revisits)."""
    out = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    arrow = arrow_schema(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                count, rows = 0, []
                with system.open_input_stream(f"{path}/{row['file']}", compression=None) as stream:
                    for page_id, url, kind, refers, size, digest, payload in read_archive(stream):
                        count += 1
                        rows.append((page_id, url, size, digest, kind, refers, *([payload] if payloads else [])))
                        if len(rows) == SLICE:
                            yield record_batch(rows, arrow)
                            rows = []
                if rows:
                    yield record_batch(rows, arrow)
                if count != row["records"]:
                    raise ValueError(f"{row['file']} holds {count} records instead of {row['records']}")

    tasks = max(1, 2 * files.count())  # a stated number: the short list of names is not merged into one task
    return files.repartition(tasks, "file").mapInArrow(read, out)


def archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (``page_id``, ``url``, ``html``) and read the archives back, one row per page.

    A null html is an empty payload, a null url has no target line. A row without page_id is always a
    response; rows that repeat a page_id and payload get a record each, all of the same type. No input
    rows, no archive and no result.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return read_archives(write_archives(with_revisits(rows, least_bytes), folder), folder, payloads=False)
