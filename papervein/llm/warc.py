"""WARC archives as tables of chunks, written and read back as streams.

An archive is a sequence of chunks of at most ``CHUNK_BYTES``; put end to end they are a WARC
file.  The writer cuts records into chunks as it goes, the reader follows the stream from
chunk to chunk, so neither ever holds a whole record: a payload comes back as rows of record
and chunk number, each with the digest of the payload up to there.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest id
holds the payload (response) and the others refer to it (revisit); smaller ones are all
responses.

A null html is an empty payload, a null url leaves out the target.  Rows that repeat the
largest id are all responses.  A row without id can only revisit; if no row of its payload
has an id, it is a response.  Line breaks in urls are percent-encoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.llm.shared import Tables

CHUNK_BYTES = 256 << 10
ARCHIVE_BYTES = 64 << 20
REVISIT_BYTES = 1000
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame) -> DataFrame:
    """The record type of every page and the page it refers to, with its payload."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    records = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = F.length("payload") >= REVISIT_BYTES
    holders = (
        records.where(large).groupBy("digest").agg(F.count("*").alias("copies"), F.max("page_id").alias("holder"))
        .where("copies > 1 AND holder IS NOT NULL").select("digest", "holder")
    )
    # A payload with very many copies: the side with one row a digest lets Spark split the other.
    joined = records.join(holders, "digest", "left")
    revisit = large & F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("holder")).alias("refers_to")
    )


def _head(page: int | None, url: str | None, size: int, digest: str, refers: int | None, number: str) -> bytes:
    """Everything of a record ahead of its payload."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    ).encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}:{number}>", "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    if refers is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {_PROFILE}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (size if refers is None else 0)}",
    ]
    return "\r\n".join(lines).encode() + _END + http


def write_archives(records: DataFrame) -> DataFrame:
    """(archive, chunk_no, data) of the records that ``plan_records`` gives."""

    def written(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        archive, chunk, size, number = partition << 32, 0, 0, 0
        pending = bytearray()
        chunk_bytes = CHUNK_BYTES

        def row(data: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([archive], pa.int64()), pa.array([chunk], pa.int64()), pa.array([data], pa.binary())],
                names=["archive", "chunk_no", "data"],
            )

        for batch in parts:
            for k in range(len(batch)):
                page, url, payload, digest, refers = (batch.column(c)[k] for c in range(5))
                body = payload.as_buffer()
                head = _head(page.as_py(), url.as_py(), body.size, digest.as_py(), refers.as_py(), f"{partition}-{number}")
                number += 1
                for piece in (memoryview(head), memoryview(body if refers.as_py() is None else b""), memoryview(_END)):
                    at = 0
                    while at < len(piece):
                        step = min(len(piece) - at, chunk_bytes - len(pending))
                        pending += piece[at : at + step]
                        at += step
                        if len(pending) == chunk_bytes:
                            yield row(bytes(pending))
                            chunk, size = chunk + 1, size + chunk_bytes
                            pending.clear()
                if size + len(pending) >= ARCHIVE_BYTES:
                    if pending:
                        yield row(bytes(pending))
                    pending.clear()
                    archive, chunk, size = archive + 1, 0, 0
        if pending:
            yield row(bytes(pending))

    return records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(
        written, "archive long, chunk_no long, data binary"
    )


def _page(urn: str) -> int | None:
    """The id in ``<urn:page:id>`` or ``<urn:page:id:number>``."""
    number = urn.removeprefix("<urn:page:").rstrip(">").split(":")[0]
    return int(number) if number else None


@dataclass
class _Reader:
    """Follows the bytes of one archive."""

    archive: int
    pending: bytearray = field(default_factory=bytearray)
    state: str = "head"
    left: int = 0

    def feed(self, data: bytes) -> Iterator[tuple]:
        """Rows (record, chunk_no, data, bytes so far, digest so far, last, type, refers, valid)."""
        self.pending += data
        while True:
            if self.state in ("head", "http"):
                end = self.pending.find(_END)
                if end < 0:
                    return
                text = bytes(self.pending[:end]).decode()
                del self.pending[: end + 4]
                fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in text.split("\r\n")[1:])}
                if self.state == "head":
                    self.fields, self.left, self.state = fields, int(fields["content-length"]), "http"
                    continue
                self.left -= end + 4
                self.http, self.size, self.chunk, self.digest = fields, 0, 0, hashlib.sha1()
                self.state = "payload"
            if self.state == "payload":
                step = min(self.left, len(self.pending))
                if not step and self.left:
                    return
                piece = bytes(self.pending[:step])
                del self.pending[:step]
                self.left -= step
                self.size += step
                self.digest.update(piece)
                yield self._row(piece, not self.left)
                self.chunk += 1
                if self.left:
                    return
                self.state = "tail"
            if self.state == "tail":
                if len(self.pending) < 4:
                    return
                del self.pending[:4]
                self.state = "head"

    def _row(self, piece: bytes, last: bool) -> tuple:
        kind = self.fields["warc-type"]
        said = self.fields["warc-payload-digest"].removeprefix("sha1:")
        page, refers = _page(self.fields["warc-record-id"]), _page(self.fields.get("warc-refers-to", ""))
        if kind == "revisit":  # its payload is elsewhere; the HTTP head and the record tell of it
            size, digest, valid = int(self.http["content-length"]), said, True
        else:
            size, digest = self.size, self.digest.hexdigest()
            valid = not last or (digest == said and size == int(self.http["content-length"]))
        return (
            self.fields["warc-record-id"], page, self.fields.get("warc-target-uri"), kind, refers,
            self.chunk, piece, size, digest, last, valid,
        )


RECORDS = (
    "record_id string, page_id long, url string, record_type string, refers_to long, chunk_no long, data binary, "
    "payload_bytes long, payload_digest string, last boolean, valid boolean"
)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records as rows of chunks; the row with ``last`` has the whole payload's digest.

    ``valid`` is false on the last row of a payload that does not fit the digest or length
    its record states.
    """
    types = (
        pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(),
        pa.bool_(), pa.bool_(),
    )
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in parts:
            for k in range(len(batch)):
                archive = batch.column(0)[k].as_py()
                if reader is None or reader.archive != archive:
                    reader = _Reader(archive)
                rows = list(reader.feed(batch.column(2)[k].as_py()))
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    ordered = archives.select("archive", "chunk_no", "data").repartition("archive").sortWithinPartitions("archive", "chunk_no")
    return ordered.mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a record for every page, read the archives back, and return one row a page."""
    tables = Tables(pages.sparkSession, "warc")
    archives = tables.write(write_archives(plan_records(pages)), "archives")
    return (
        read_archives(archives).where("last")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid")
    )
