"""WARC archives: a writer with revisit records and a salvage reader.

Writing: each page becomes one gzip member with one record. Of the pages with equal
payloads of at least ``REVISIT_BYTES`` bytes, that with the largest id is a ``response``,
the others are ``revisit`` records that name it and carry no payload; smaller payloads are
all ``response``. Which is which comes from an aggregate over digests (combined before
the shuffle) joined back; Spark splits the join where one digest has most rows.

Salvage reading: records are read one after the other and each is checked (the member's
own checksum, the version line, the headers, the stated length, the block and payload
digests). After a failed check the reader searches on, from the byte after the bad
record's start, for the next valid member (its magic number, and a version line that
decompresses from it) or, in plain files, the next version line; from there it recovers
later records. The bytes passed over are logged as a gap with the reason. Files are read in
blocks, so memory is bounded by the largest record.

Files are dealt to tasks, one row a file. Archives are cut at ``ARCHIVE_BYTES``; a file
appears only when whole, and the table of archives holds those of tasks that succeeded.

Defined cases: a NULL payload is empty; a NULL id is written as such and read back NULL; of
repeated ids with equal payloads all rows with the largest id are responses; a
NULL url is an empty target; control characters in a url are percent-encoded;
an empty table gives no archive; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored
from .files import NewFile, open_file

REVISIT_BYTES, ARCHIVE_BYTES, READ_BYTES = 1000, 1 << 25, 1 << 18
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_NEXT_VERSION = re.compile(rb"\r\nWARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"


# ---- records --------------------------------------------------------------------
def record(page_id: int | None, url: str | None, payload: bytes, digest: str, n_bytes: int, refers_to: int | None, kind: str) -> bytes:
    """One record; a revisit has no payload but its digest and length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
    block = http + (payload if kind == "response" else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("X-Payload-Length", str(n_bytes)),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


class Bad(Exception):
    """A record failed a check."""


def parse(data: bytes, whole: bool = True) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and length of the record at the start of ``data``; raises ``Bad``."""
    if not _VERSION_LINE.match(data):
        raise Bad("no version line")
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise Bad("headers do not end")
    headers = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("malformed header")
        name = name.decode("latin-1").strip().lower()
        if name in headers and name != "warc-concurrent-to":
            raise Bad("repeated header")  # as where another record begins inside the headers
        headers[name] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or "warc-type" not in headers:
        raise Bad("headers lack a length or type")
    start, stop = end + 4, end + 4 + int(length)
    if len(data) < stop + 4 or data[stop:stop + 4] != b"\r\n\r\n":
        raise Bad("block is cut short or runs on")
    block = data[start:stop]
    algorithm, _, want = headers.get("warc-block-digest", "").partition(":")
    if algorithm == "sha1" and len(want) == 40 and hashlib.sha1(block).hexdigest() != want.lower():
        raise Bad("block digest differs")
    return headers, block, stop + 4


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    if headers.get("content-type", "").startswith("application/http"):
        head, gap, body = block.partition(b"\r\n\r\n")
        return body if gap else b""
    return block


class Salvage:
    """Records and gaps of one archive, gzip members or plain.

    ``read()`` yields ``("record", start, end, headers, block)`` and
    ``("gap", start, end, reason)`` in file order; together they tile the file.
    """

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.buffer, self.at = b"", 0

    def bytes_at(self, start: int, n: int) -> bytes:
        if start < self.at or start + n > self.at + len(self.buffer):
            self.file.seek(start)
            self.buffer, self.at = self.file.read(max(n, READ_BYTES)), start
        return self.buffer[start - self.at:start - self.at + n]

    def member(self, start: int) -> tuple[bytes, int]:
        """The whole member at ``start``, checksum verified, and its end."""
        z, out, at = zlib.decompressobj(31), [], start
        while not z.eof:
            chunk = self.bytes_at(at, min(READ_BYTES, self.size - at))
            if not chunk:
                raise Bad("member is cut short")
            try:
                out.append(z.decompress(chunk))
            except zlib.error as e:
                raise Bad("member does not decompress") from e
            at += len(chunk)
        return b"".join(out), at - len(z.unused_data)

    def header_size(self, start: int) -> int:
        """Bytes from ``start`` to the empty line after the headers, however far; the search
        ends at another version line, so that all searches of a file pass over it about once."""
        at = start
        while at < self.size:
            chunk = self.bytes_at(at, min(READ_BYTES, self.size - at))
            end, other = chunk.find(b"\r\n\r\n"), _NEXT_VERSION.search(chunk)
            if other and (end < 0 or other.start() < end):
                raise Bad("malformed header")
            if end >= 0:
                return at + end - start
            if at + len(chunk) >= self.size:
                break
            at += max(1, len(chunk) - 11)  # either mark may lie across the end
        raise Bad("headers do not end")

    def plain(self, start: int) -> tuple[dict[str, str], bytes, int]:
        if not _VERSION_LINE.match(self.bytes_at(start, min(10, self.size - start))):
            raise Bad("no version line")
        gap = self.header_size(start)
        head = self.bytes_at(start, min(max(READ_BYTES, gap + 4), self.size - start))
        m = re.search(rb"\r\ncontent-length:[ \t]*(\d{1,18})\r\n", head[:gap + 4], re.I)
        if m and gap + 8 + int(m.group(1)) <= self.size - start:
            head = self.bytes_at(start, gap + 8 + int(m.group(1)))
        return parse(head)

    def record(self, start: int):
        if self.bytes_at(start, 3) == _GZIP:
            data, end = self.member(start)
            headers, block, used = parse(data)
            if used != len(data):
                raise Bad("member holds more than its record")
            return headers, block, end
        headers, block, used = self.plain(start)
        return headers, block, start + used

    def starts_here(self, at: int) -> bool:
        """Whether a valid member or a version line seems to start at ``at``."""
        if self.bytes_at(at, 3) != _GZIP:
            return bool(_VERSION_LINE.match(self.bytes_at(at, 10)))
        try:
            return bool(_VERSION_LINE.match(zlib.decompressobj(31).decompress(self.bytes_at(at, 4096), 64)))
        except zlib.error:
            return False

    def next_start(self, at: int) -> int:
        """The next place from ``at`` on where a record seems to start, or the end."""
        while at < self.size:
            chunk = self.bytes_at(at, min(READ_BYTES, self.size - at))
            for m in re.finditer(rb"\x1f\x8b\x08|WARC/1\.", chunk):
                if m.start() + 10 <= len(chunk) or at + len(chunk) == self.size:
                    if self.starts_here(at + m.start()):
                        return at + m.start()
            if at + len(chunk) >= self.size:
                break
            at += max(1, len(chunk) - 9)
        return self.size

    def read(self):
        at = 0
        gap, reason = None, ""
        while at < self.size:
            try:
                headers, block, end = self.record(at)
            except Bad as e:
                if gap is None:
                    gap, reason = at, str(e)
                at = self.next_start(at + 1)
                continue
            if gap is not None:
                yield "gap", gap, at, reason
                gap = None
            yield "record", at, end, headers, block
            at = end
        if gap is not None:
            yield "gap", gap, self.size, reason


# ---- tables to archives and back --------------------------------------------------
ARCHIVES = "path string, n_records long, n_bytes long"
RECORDS = ("path string, start long, stop long, gap_reason string, record_type string, page_id long, target string, "
           "payload_bytes long, payload_digest string, refers_to long, payload_ok boolean")


def _id(text: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", text)
    return int(m.group(1)) if m else None


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, n_bytes, refers_to``; ``payload`` is NULL for revisits."""
    each = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    each = each.withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")})
    equal = each.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1")
    joined = each.join(equal.select("digest", "kept"), "digest", "left")
    other = (F.col("n_bytes") >= least) & F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return joined.select("page_id", "url", F.when(~F.coalesce(other, F.lit(False)), F.col("payload")).alias("payload"), "digest", "n_bytes",
                         F.when(other, F.col("kept")).alias("refers_to"))


def write_warc(pages: DataFrame, out_dir: str, least: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of ``pages(page_id, url, html)``; returns the table of archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, number, out, n = TaskContext.get(), 0, None, 0

        def row() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([n], pa.int64()), pa.array([out.size], pa.int64())], names=["path", "n_records", "n_bytes"])

        for b in batches:
            for page, url, payload, digest, n_bytes, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name = f"{out_dir}/part-{context.partitionId():06d}-{number:04d}-{context.taskAttemptId()}.warc.gz"
                    out, n = NewFile(name), 0
                    out.name = name
                kind = "response" if payload is not None else "revisit"
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(z.compress(record(page, url, payload or b"", digest, n_bytes, refers_to, kind)) + z.flush())
                n += 1
                if out.size >= archive_bytes:
                    yield row()
                    out, number = None, number + 1
        if out is not None:
            yield row()

    return stored(with_revisits(pages, least).mapInArrow(run, ARCHIVES), "warc-archives")


def read_warc(archives: DataFrame, whole: bool = False) -> DataFrame:
    """All records and gaps of the archives in ``archives(path)``, by salvage reading
    (``whole``: a gap is an error).

    A row is a record, or a quarantined gap if ``gap_reason`` is set. ``payload_ok``: the
    payload has the stated digest (NULL for revisits, which carry none).
    """
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("gap_reason", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                        ("target", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload_ok", pa.bool_())])

    def rows_of(path: str) -> Iterator[tuple]:
        file = open_file(path)
        for kind, start, end, *rest in Salvage(file, file.size()).read():
            if kind == "gap":
                if whole:
                    raise ValueError(f"{path} has a gap from byte {start} to {end}: {rest[0]}")
                yield (path, start, end, rest[0], *[None] * 7)
                continue
            headers, block = rest
            stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
            if headers["warc-type"] == "revisit":
                n, digest, ok = headers.get("x-payload-length", ""), stated, None
                n = int(n) if n.isascii() and n.isdigit() else None
            else:
                payload = payload_of(headers, block)
                n, digest = len(payload), hashlib.sha1(payload).hexdigest()
                ok = digest == stated.lower() if stated else None
            yield (path, start, end, None, headers["warc-type"], _id(headers.get("warc-record-id", "")), headers.get("warc-target-uri", ""), n, digest,
                   _id(headers.get("warc-refers-to", "")), ok)
        file.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                for r in rows_of(path):
                    rows.append(r)
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return archives.select("path").repartition(max(1, archives.count())).mapInArrow(run, RECORDS)


def warc_report(pages: DataFrame) -> DataFrame:
    """One row per page, read back from the archives, which must be whole."""
    archives = write_warc(pages, scratch_path(pages.sparkSession, "warc"))
    return read_warc(archives, whole=True).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
