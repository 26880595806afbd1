"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

The writer makes uncompressed WARC 1.1 files through Spark's text writer, whose line
separator closes each record, so a lost task leaves no part of a file behind.  The reader
takes whole files, plain or of one gzip member for each record.  A record that fails a
check (version line, headers, length, closing line breaks, payload digest, gzip checksum)
is not the end: the reader looks for the next member or version line from which a record
passes, goes on there, and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slot_count, slot_flags, slots_of_hash, stored

VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
#: Payloads shorter than this are never stored as revisits.
LEAST_REVISIT = 1000
DATE = "2020-01-01T00:00:00Z"
#: Bytes that are unpacked together, and that the headers of a record in a gzip member may have.
STEP, HEAD_BYTES = 1 << 16, 1 << 24
#: Bytes that one value of a row can have.
LARGEST_VALUE = (1 << 31) - 1 - (1 << 10)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _clean(value: str | None) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value or "").strip()


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record without its last line break; a revisit carries no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": _clean(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Page-ID": "" if page_id is None else str(page_id),
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        headers |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": record_id(refers_to, digest),
            "X-Refers-To-Page-ID": str(refers_to),
        }
    head = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return VERSION + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n"


def as_member(record: bytes) -> bytes:
    """A whole record (``build_record`` and a line break) as a gzip member of its own."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


@dataclass
class Found:
    """A record that passed its checks, or with ``reason`` a gap of ``length`` bytes."""

    offset: int
    length: int
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes | None = None
    payload_bytes: int = 0
    digest: str = ""
    reason: str | None = None


def _headers(head: bytes) -> tuple[dict[str, str], int]:
    """Names and values of a record's header lines, and the length of its block."""
    headers = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header without a colon")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise ValueError("no content length")
    return headers, int(length)


def _is_http(headers: dict[str, str]) -> bool:
    return headers.get("content-type", "").startswith("application/http")


def _checked(found: Found) -> Found:
    digest = found.headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if digest and found.headers.get("warc-type") != "revisit" and digest != found.digest:
        raise ValueError("payload digest differs")
    return found


def _parse_plain(data, start: int) -> Found:
    """The record at ``start``; ValueError says which check failed."""
    version = _VERSION.match(data, start)
    if not version:
        raise ValueError("no version line")
    head_end = data.find(END, start)
    following = _VERSION.search(data, version.end())
    if head_end < 0 or (following and following.start() < head_end):
        raise ValueError("headers do not end")
    headers, length = _headers(data[version.end() : head_end])
    body, end = head_end + len(END), head_end + len(END) + length
    if data[end : end + len(END)] != END:
        raise ValueError("block is not closed where its length says")
    if _is_http(headers):
        split = data.find(END, body, end)
        if split < 0:
            raise ValueError("HTTP headers do not end")
        body = split + len(END)
    payload = data[body:end]
    return _checked(Found(start, end + len(END) - start, headers, payload, len(payload), hashlib.sha1(payload).hexdigest()))


class _Member:
    """The bytes of a gzip member, some at a time, so that its size does not matter."""

    def __init__(self, data: bytes, start: int):
        self.view, self.at, self.unpacker, self.held = memoryview(data), start, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Unpack some more bytes; false at the member's end."""
        try:
            while not self.unpacker.eof:
                piece = self.unpacker.unconsumed_tail
                if not piece:
                    piece = self.view[self.at : self.at + STEP]
                    self.at += len(piece)
                out = self.unpacker.decompress(piece, STEP)
                if out:
                    self.held += out
                    return True
                if not piece and not self.unpacker.eof:
                    raise ValueError("gzip member does not end")
        except zlib.error as e:
            raise ValueError(f"gzip: {e}") from None
        return False

    def until(self, mark: bytes, reason: str, within: int | None = None) -> bytes:
        """The bytes before the mark, which is taken too; within so many bytes, and within ``HEAD_BYTES``."""
        most = HEAD_BYTES if within is None else min(within, HEAD_BYTES)
        while (at := self.held.find(mark)) < 0 and len(self.held) < most and self.more():
            pass
        if at < 0 or at + len(mark) > most:
            raise ValueError(reason)
        taken, self.held = self.held[:at], self.held[at + len(mark) :]
        return taken

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes in pieces; fewer where the member ends."""
        while n > 0 and (self.held or self.more()):
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            yield piece


def _parse_member(data: bytes, start: int, keep: bool) -> Found:
    """The record in the gzip member at ``start``, its payload only if it is to be kept."""
    member = _Member(data, start)
    head = member.until(END, "headers do not end")
    version = _VERSION.match(head + b"\r\n")
    if not version:
        raise ValueError("no version line")
    if _VERSION.search(head, version.end()):
        raise ValueError("headers do not end")
    headers, length = _headers(head[version.end() :])
    if _is_http(headers):
        length -= len(member.until(END, "HTTP headers do not end", length)) + len(END)
    sha1, size, parts = hashlib.sha1(), 0, []
    for piece in member.take(length):
        sha1.update(piece)
        size += len(piece)
        keep = keep and size <= LARGEST_VALUE
        if keep:
            parts.append(piece)
    if size < length or b"".join(member.take(len(END))) != END:
        raise ValueError("block is not closed where its length says")
    if member.held or member.more():
        raise ValueError("gzip member holds more than its record")
    end = member.at - len(member.unpacker.unused_data)
    return _checked(Found(start, end - start, headers, b"".join(parts) if keep else None, size, sha1.hexdigest()))


def salvage(data: bytes, keep: bool = True) -> Iterator[Found]:
    """Records of an archive in their order, and the gaps between them.

    From a place that fails, candidates are the next gzip magic numbers and version lines;
    the first from which a record passes ends the gap.  An empty file holds nothing.
    Members of any size are read; without ``keep`` a member's payload is counted and
    digested only.
    """
    marks = re.compile(re.escape(_GZIP) + rb"|WARC/1\.[01]\r\n")
    at, gap, reason = 0, 0, None

    def attempt(start: int) -> Found:
        return _parse_member(data, start, keep) if data[start : start + 3] == _GZIP else _parse_plain(data, start)

    while at < len(data):
        try:
            found = attempt(at)
        except ValueError as e:
            reason = reason or str(e)
            following = marks.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap < at:
            yield Found(gap, at - gap, reason=reason)
        yield found
        at = gap = at + found.length
        reason = None
    if gap < len(data):
        yield Found(gap, len(data) - gap, reason=reason)


def _with_digest(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    html = F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8")
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload")).withColumn("digest", F.sha1("payload"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", file_bytes: int = 64 << 20) -> None:
    """A record for each row of ``pages``, into files below ``path``.

    Of rows with equal payloads of at least 1000 bytes those with the largest id are
    responses, and the others, null ids too, are revisits of it; when all their ids are
    null all are responses.  Null pages are empty payloads.  Files hold as many records as
    keep them near ``file_bytes``, one at least, however long.
    """
    read = _with_digest(pages, id_col, url_col, html_col)
    length = F.octet_length("payload")
    kept = stored(read.where(length >= LEAST_REVISIT).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("rows")).where("rows > 1 AND kept IS NOT NULL").drop("rows"), "kept")
    longest = read.agg(F.max(length)).head()[0] or 0
    # Flags of the repeated digests keep all other payloads out of the join's shuffle.
    n_slots = slot_count(kept.count())
    flags = slot_flags(kept.select(F.xxhash64("digest")), n_slots)
    one, other = slots_of_hash(F.xxhash64("digest"), n_slots)
    repeated = (length >= LEAST_REVISIT) & F.get(flags, one) & F.get(flags, other)
    refers = F.when(F.coalesce(F.col("page_id") != F.col("kept"), F.col("kept").isNotNull()), F.col("kept"))
    columns = ("page_id", "url", "payload", "digest")
    linked = read.where(repeated).join(kept, "digest", "left").select(*columns, refers.alias("refers_to"))
    linked = linked.unionByName(read.where(~repeated).select(*columns, F.lit(None).cast("long").alias("refers_to")))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                rows = batch.slice(start, 64).to_pylist()
                records = [build_record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"]) for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    per_file = max(1, min(20_000, file_bytes // (longest + 2000)))
    records = linked.mapInArrow(build, "record binary")
    # Bytes pass the text writer as they are; each record ends with the separator.
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n").option("maxRecordsPerFile", per_file).mode("overwrite").text(path)


RECORD_SCHEMA = "file string, offset long, length long, reason string, warc_type string, url string, page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_archives(spark, path: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives below ``path``, a row each.

    A gap has a reason and no type.  Payloads of revisits are empty, but payload_bytes and
    payload_digest are those of the whole payload, as the headers say.  A payload that is
    larger than a value can be (2 GB) is null, with its size and digest.  An archive is one
    value itself, so it may have 2 GB, packed or not.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path", "content")

    def number(text: str | None) -> int | None:
        return int(text) if text and text.lstrip("-").isdigit() else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()), ("warc_type", pa.string()), ("url", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                path, data, rows, held = batch.column("path")[i].as_py(), batch.column("content")[i].as_py(), [], 0
                for r in salvage(data, with_payload):
                    h = r.headers
                    row = {"file": path, "offset": r.offset, "length": r.length, "reason": r.reason}
                    if r.reason is None:
                        revisit = h.get("warc-type") == "revisit"
                        row |= {
                            "warc_type": h.get("warc-type"),
                            "url": h.get("warc-target-uri"),
                            "page_id": number(h.get("x-page-id")),
                            "refers_to": number(h.get("x-refers-to-page-id")),
                            "payload_bytes": number(h.get("x-payload-length")) if revisit else r.payload_bytes,
                            "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else r.digest,
                            "payload": r.payload if with_payload and r.payload_bytes <= LARGEST_VALUE else None,
                        }
                        held += r.payload_bytes if with_payload else 0
                    rows.append(row)
                    if len(rows) >= 1000 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(parse, RECORD_SCHEMA)
