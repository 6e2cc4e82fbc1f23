"""Web archives: pages as gzipped WARC records, equal payloads stored once, and a
reader that splits files at any byte."""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .storage import open_folder, written

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


@dataclass(frozen=True)
class Archive:
    """least_bytes: smaller payloads are never stored as a revisit. date: of all
    records. level: of compression. split_bytes: range of one reading task.
    broadcast_bytes: largest list of repeated payloads that is sent to all tasks."""

    least_bytes: int = 100
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6
    split_bytes: int = 8 << 20
    broadcast_bytes: int = 64 << 20


def _record(page_id, url, payload: bytes, digest: str, refers_to, archive: Archive) -> bytes:
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    )
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {archive.date}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        # Bytes that would end the line, and others that a header cannot hold, are escaped.
        lines.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=~ ", encoding="utf-8"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def _write(folder: str, archive: Archive):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = open_folder(folder)
        filesystem.create_dir(path, recursive=True)
        name = f"pages-{TaskContext.get().partitionId():05d}.warc.gz"
        draft = posixpath.join(path, f"_{name}.{uuid.uuid4().hex}")
        n_bytes = records = 0
        with filesystem.open_output_stream(draft) as out:
            for batch in batches:
                for row in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]):
                    page_id, url, html, digest, refers_to = row
                    whole = _record(page_id, url, (html or "").encode(), digest, refers_to, archive)
                    pack = zlib.compressobj(archive.level, zlib.DEFLATED, 31)
                    member = pack.compress(whole) + pack.flush()
                    out.write(member)
                    n_bytes += len(member)
                    records += 1
        filesystem.move(draft, posixpath.join(path, name))
        if records:
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "bytes": [n_bytes], "records": [records]},
                schema=pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]),
            )

    return write


def write_archive(pages: DataFrame, folder: str, archive: Archive = Archive()) -> DataFrame:
    """Write a record for every row of pages (page_id, url, html) to a new folder
    and return the list of its files: file, bytes, records.

    Null html is an empty payload, a null url has no target line. Of payloads of
    at least archive.least_bytes that are equal, the one of the smallest page_id
    is kept and the others refer to it; rows that repeat this page_id are kept
    too. Rows without a page_id refer to the smallest one there is, or are kept.

    Only digests are grouped; pages are looked up in the list of repeated
    digests, sent to all tasks while that is small and joined by a shuffle, with
    large digests split by adaptive execution, beyond.
    """
    html = F.coalesce("html", F.lit(""))
    digested = pages.select("page_id", "url", "html", F.sha2(html.cast("binary"), 256).alias("digest"))
    size = F.octet_length(html)
    repeated = written(
        digested.where(size >= archive.least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first"),
        "repeated",
    )
    small = repeated.count() * 160 <= archive.broadcast_bytes
    looked_up = digested.join(F.broadcast(repeated) if small else repeated, "digest", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    files = looked_up.select("page_id", "url", "html", "digest", refers.alias("refers_to")).mapInArrow(
        _write(folder, archive), "file string, bytes long, records long"
    )
    return written(files, "archive-files")


@dataclass
class _Source:
    """Bytes of a file from a place on, read as they are asked for."""

    file: object
    size: int
    at: int
    chunk: int = 1 << 20
    held: bytes = b""

    def upto(self, end: int) -> None:
        """Hold the bytes up to a place, or to the end of the file."""
        while self.at + len(self.held) < min(end, self.size):
            start = self.at + len(self.held)
            self.file.seek(start)
            more = self.file.read(max(self.chunk, end - start))
            if not more:
                self.size = start
                return
            self.held += more

    def drop(self, to: int) -> None:
        if to > self.at:
            self.held = self.held[to - self.at :]
            self.at = to


class DamagedArchive(ValueError):
    """Bytes of an archive that are no whole records."""


def _member(source: _Source, start: int) -> tuple[bytes, int] | None:
    """Content and end of the gzip member at a place; None if no WARC record
    begins there. Raises where one begins and does not go on whole."""
    unpack = zlib.decompressobj(31)
    content, at = [], start
    try:
        while not unpack.eof:
            source.upto(at + 65536)
            piece = source.held[at - source.at : at - source.at + 65536]
            if not piece:
                if content:
                    raise DamagedArchive(f"the record at byte {start} is cut off")
                return None
            content.append(unpack.decompress(piece))
            at += len(piece)
            if len(content) == 1 and not content[0].startswith(b"WARC/1."):
                return None
    except zlib.error as error:
        if content:
            raise DamagedArchive(f"the record at byte {start} does not decode: {error}") from error
        return None if _head(source, start) is None else _damaged(start)
    return b"".join(content), at - len(unpack.unused_data)


def _damaged(start: int):
    raise DamagedArchive(f"the record at byte {start} does not decode")


def _head(source: _Source, start: int) -> bytes | None:
    """The first bytes of the WARC record at a place, if one begins there."""
    source.upto(start + 65536)
    unpack = zlib.decompressobj(31)
    try:
        head = unpack.decompress(source.held[start - source.at : start - source.at + 65536], len(b"WARC/1."))
    except zlib.error:
        return None
    return head if head == b"WARC/1." else None


def _parse(content: bytes) -> dict | None:
    """Fields of a record; None if its length is not the one it states."""
    head, _, rest = content.partition(END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    length = int(fields.get("Content-Length", -1))
    if length < 0 or len(rest) != length + len(END):
        return None
    http, _, payload = rest[:length].partition(END)
    sizes = [line.split(b":", 1)[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    return {"fields": fields, "payload": payload, "full": int(sizes[0]) if sizes else len(payload)}


def records_in(file, size: int, start: int, end: int) -> Iterator[dict]:
    """Records that start in a range of bytes of a file. The range may begin
    anywhere: places of the gzip magic are tried until one decodes to the head of
    a record; from there members follow one another.

    Raises DamagedArchive where bytes are lost. A record that begins and does not
    decode is damaged, and so is a place right behind a record where no other
    begins. The last record of a range answers for the place behind it, which
    lies in a later range; so the ranges of a file together cover all its bytes.
    """
    source, at, certain = _Source(file, size, start), start, start == 0
    while at < min(end, source.size):
        if not certain:
            source.upto(at + (1 << 16))
            place = source.held.find(MAGIC, at - source.at)
            if place < 0:
                # The magic may begin in the last two bytes held.
                at = max(at + 1, source.at + len(source.held) - 2)
                source.drop(at)
                continue
            at = source.at + place
            if at >= end:
                return
        found = _member(source, at)
        if found is None:
            if certain:
                raise DamagedArchive(f"no record begins at byte {at}")
            at += 1
            continue
        record = _parse(found[0])
        if record is None:
            raise DamagedArchive(f"the record at byte {at} has not the length it states")
        yield record
        at, certain = found[1], True
        source.drop(at)
    if certain and at < size and _head(source, at) is None:
        raise DamagedArchive(f"no record begins at byte {at}")


def _id(text: str | None):
    digits = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _named(name: str, records: Iterator[dict]) -> Iterator[dict]:
    try:
        yield from records
    except DamagedArchive as error:
        raise DamagedArchive(f"{name}: {error}") from error


def _read(folder: str, payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = open_folder(folder)
        for batch in batches:
            for name, size, start, end in zip(*[batch.column(c).to_pylist() for c in ("file", "bytes", "start", "stop")]):
                with filesystem.open_input_file(posixpath.join(path, name)) as file:
                    if file.size() != size:
                        raise DamagedArchive(f"{name}: {file.size()} bytes where the list says {size}")
                    rows, held = [], 0
                    for record in _named(name, records_in(file, size, start, end)):
                        fields, payload = record["fields"], record["payload"]
                        kind = fields["WARC-Type"]
                        stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        digest = hashlib.sha256(payload).hexdigest() if kind == "response" else stated
                        if digest != stated:
                            raise DamagedArchive(f"{name}: a payload differs from its digest")
                        row = {
                            "page_id": _id(fields["WARC-Record-ID"]),
                            "url": fields.get("WARC-Target-URI"),
                            "payload_bytes": len(payload) if kind == "response" else record["full"],
                            "payload_digest": digest,
                            "record_type": kind,
                            "refers_to": _id(fields.get("WARC-Refers-To")),
                        }
                        if payloads:
                            row["payload"] = payload if kind == "response" else None
                            held += len(payload)
                        rows.append(row)
                        if held > 16 << 20 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_schema(payloads))
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_schema(payloads))

    return read


def _schema(payloads: bool) -> pa.Schema:
    fields = [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
    return pa.schema(fields + ([("payload", pa.binary())] if payloads else []))


def read_archive(files: DataFrame, folder: str, payloads: bool = True, archive: Archive = Archive()) -> DataFrame:
    """Records of the listed files (file, bytes), each file read in ranges of
    bytes by many tasks: page_id, url (as escaped), payload_bytes and
    payload_digest of the full payload, record_type, refers_to and, if wanted,
    payload (null for revisits). Payloads are held against their digests.

    A listed file that is missing, longer or shorter than the list says, or
    damaged fails the read (DamagedArchive names file and byte, see
    `records_in`): there are never fewer records than were written."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(archive.split_bytes).cast("long"))
    ranges = (
        files.where("bytes > 0")
        .select("file", "bytes", F.explode(starts).alias("start"))
        .withColumn("stop", F.col("start") + archive.split_bytes)
    )
    n = max(1, ranges.count())
    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return (
        ranges.repartitionByRange(n, "file", "start")
        .mapInArrow(_read(folder, payloads), kinds + (", payload binary" if payloads else ""))
    )
