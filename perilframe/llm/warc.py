"""WARC archives: a writer with revisit records, and a reader that salvages damaged archives.

The writer's tasks put each record into a gzip member of its own, roll archives at a bounded size and
return their names; only names of tasks that Spark committed are read again, so an attempt that was
lost leaves nothing but an unread file. The reader takes one archive per task and a record at a
time. Where a check fails (gzip's own, version line, lengths, digests) it looks for the next place at
which a member or version line begins a valid record, and reports the bytes between as a gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilframe.llm.common import shared_dir, staged, text_bytes

#: Payloads from this size on are written once; an archive is closed once it has so many bytes.
LEAST_SHARED, ARCHIVE_BYTES = 100, 32 << 20
#: Longest header block, and bytes read at a time.
MOST_HEADER, READ = 1 << 16, 1 << 18
#: Longest content of a gzip member; one that claims more is damage.
MOST_MEMBER = 1 << 30
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = b"\x1f\x8b\x08"
_BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_END = b"\r\n\r\n"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it, of a URI or a plain path."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def _name(key: object) -> str:
    """Name of a record; a null id has no part behind the colon, nor the colon."""
    return f"<urn:page:{quote(str(key), safe='')}>" if key is not None else "<urn:page>"


def _key(name: str | None) -> str | None:
    found = re.fullmatch(r"<urn:page:(.*)>", name or "")
    return unquote(found[1]) if found else None


def record(key: object, url: str | None, payload: bytes, revisits: object = None,
           revisit: bool = False) -> bytes:
    """A response record, or a revisit record with the HTTP header of the payload only."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _name(key),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else None,
        "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Refers-To": _name(revisits) if revisit else None,
        "WARC-Profile": PROFILE if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + _END


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Archive:
    """Random access to the bytes of an archive through a small window."""

    def __init__(self, handle: pa.NativeFile):
        self._handle, self.size = handle, handle.size()
        self._at, self._window = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes; fewer at the end."""
        if not (self._at <= at and at + n <= self._at + len(self._window)):
            self._handle.seek(at)
            self._at, self._window = at, self._handle.read(max(n, READ))
        return self._window[at - self._at : at - self._at + n]

    def find(self, at: int) -> int:
        """Next place from ``at`` on where a member or version line may begin, else the end."""
        while at < self.size:
            found = _BEGIN.search(part := self.read(at, READ))
            if found:
                return at + found.start()
            if at + len(part) >= self.size:
                break
            at += max(1, len(part) - 8)
        return self.size


class Damaged(ValueError):
    """Bytes that are no valid record."""


@dataclass
class Record:
    start: int
    stop: int
    fields: dict[str, str]
    payload: bytes
    payload_bytes: int
    digest: str


def _member_at(archive: Archive, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member; its checksum is verified by zlib."""
    unpacker, parts, place, size = zlib.decompressobj(31), [], at, 0
    try:
        while not unpacker.eof:
            data = unpacker.unconsumed_tail
            if not data and not (parts and len(parts[-1]) == READ):  # else more may come of what was read
                data = archive.read(place, READ)
                place += len(data)
                if not data:
                    raise Damaged("member is cut off")
            parts.append(unpacker.decompress(data, READ))
            size += len(parts[-1])
            if size > MOST_MEMBER:
                raise Damaged("member is too large")
    except zlib.error as error:
        raise Damaged(str(error)) from None
    return b"".join(parts), place - len(unpacker.unused_data)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, colon, v in pairs if colon}


def _number(fields: dict[str, str], name: str) -> int:
    if not re.fullmatch("[0-9]{1,18}", value := fields.get(name, "")):
        raise Damaged(f"no {name}")
    return int(value)


def _sha256(fields: dict[str, str], name: str, data: bytes) -> str:
    digest = hashlib.sha256(data).hexdigest()
    given = fields.get(name, "")
    if given.startswith("sha256:") and given[7:] != digest:
        raise Damaged(f"{name} differs")
    return digest


def _record(start: int, stop: int, head: bytes, block: bytes) -> Record:
    fields = _fields(head)
    for name in ("warc-type", "warc-record-id"):
        if name not in fields:
            raise Damaged(f"no {name}")
    _sha256(fields, "warc-block-digest", block)
    http, split, payload = block.partition(_END)
    is_http = split and fields.get("content-type", "").startswith("application/http")
    if not is_http:
        payload = block
    if fields.get("warc-type") == "revisit":
        size = _number(_fields(http), "content-length") if is_http else 0
        return Record(start, stop, fields, b"", size, fields.get("warc-payload-digest", "").removeprefix("sha256:"))
    return Record(start, stop, fields, payload, len(payload), _sha256(fields, "warc-payload-digest", payload))


def _records_at(archive: Archive, at: int) -> list[Record]:
    """The plain record, or the records of the member, that begin at the place."""
    if archive.read(at, 3) == _GZIP:
        data, stop = _member_at(archive, at)
        records, place = [], 0
        while place < len(data) or not records:
            head, place, block = _split(lambda a, n, d=data: d[a : a + n], place, len(data))
            records.append(_record(at, stop, head, block))
        return records
    head, stop, block = _split(archive.read, at, archive.size)
    return [_record(at, stop, head, block)]


def _split(read, at: int, size: int) -> tuple[bytes, int, bytes]:
    """Header, end and block of the record that ``read`` gives; there are ``size`` bytes to read."""
    start = read(at, MOST_HEADER)
    found = _VERSION.match(start)
    end = start.find(_END)
    if not found or end < 0:
        raise Damaged("no version line or header")
    head = start[found.end() : end]
    n = _number(_fields(head), "content-length")
    if n > size - at - end - 8:
        raise Damaged("record is longer than the archive")
    body = read(at + end + 4, n + 4)
    if len(body) != n + 4 or not body.endswith(_END):
        raise Damaged("record does not end where it should")
    return head, at + end + 8 + n, body[:n]


def salvage(archive: Archive) -> Iterator[Record | tuple[int, int, str]]:
    """Records in their order, and (start, stop, reason) of every gap between valid ones."""
    at, gap, reason = 0, None, ""
    while at < archive.size:
        try:
            records = _records_at(archive, at)
        except Damaged as error:
            gap, reason = (at, str(error)) if gap is None else (gap, reason)
            at = archive.find(at + 1)
            continue
        if gap is not None:
            yield gap, at, reason
            gap = None
        yield from records
        at = records[-1].stop
    if gap is not None:
        yield gap, archive.size, reason


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """Write a record per row below ``folder``, which all executors reach; returns (path, n_records,
    n_bytes) of the archives.

    Null html is an empty payload, a null url is left out. Of equal payloads of LEAST_SHARED bytes or
    more the rows with the smallest id (null after all) are responses, the others revisit it.
    """
    page = pages.select(
        F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    shared = page.where(F.octet_length("html") >= LEAST_SHARED).groupBy("digest").agg(
        F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    marked = page.join(shared.withColumn("again", F.lit(True)), "digest", "left").select(
        "id", "url", "html", "first", (F.col("again").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"))

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        context = TaskContext.get()
        own = f"{root}/{context.partitionId():06d}-{context.taskAttemptId()}"
        out, done = None, []
        for batch in batches:
            if not out and batch.num_rows:
                system.create_dir(root, recursive=True)
            columns = (batch.column(i).to_pylist() for i in (0, 1))
            for key, link, body, first, revisit in zip(
                    *columns, text_bytes(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                if out is None:
                    out = system.open_output_stream(path := f"{own}-{len(done):04d}.warc.gz", compression=None)
                    done.append([path, 0, 0])
                data = member(record(key, link, body, first, revisit))
                out.write(data)
                done[-1][1] += 1
                done[-1][2] += len(data)
                if done[-1][2] >= ARCHIVE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if done:
            scheme = folder[: len(folder) - len(folder.split("://", 1)[-1])] if "://" in folder else ""
            names = [f"{scheme}{p}" if scheme == "file://" else p for p, _, _ in done]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                ["path", "n_records", "n_bytes"])

    return staged(marked.mapInArrow(put, "path string, n_records long, n_bytes long"))


_ROW = (
    "path string, start long, stop long, kind string, reason string, id string, refers_to string, url string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def read(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record (kind response, revisit or another WARC type) and per gap (kind ``gap``) of
    the archives in ``archives(path)``. Bytes of a gap are in no record. An archive is one task's
    work; payloads are returned on request."""

    def get(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t])
                            for n, t in (c.split() for c in _ROW.split(", "))])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = filesystem(path)
                rows, held = [], 0
                with system.open_input_file(name) as handle:
                    for found in salvage(Archive(handle)):
                        if isinstance(found, tuple):
                            start, stop, reason = found
                            rows.append({"path": path, "start": start, "stop": stop, "kind": "gap", "reason": reason})
                        else:
                            held += len(found.payload) if payloads else 0
                            rows.append({
                                "path": path, "start": found.start, "stop": found.stop,
                                "kind": found.fields.get("warc-type"),
                                "id": _key(found.fields.get("warc-record-id")),
                                "refers_to": _key(found.fields.get("warc-refers-to")),
                                "url": found.fields.get("warc-target-uri"),
                                "payload_bytes": found.payload_bytes, "payload_digest": found.digest,
                                "payload": found.payload if payloads else None,
                            })
                        if len(rows) >= 1000 or held >= ARCHIVE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, archives.count())
    return archives.select("path").repartition(files).mapInArrow(get, _ROW)


def round_trip(spark: SparkSession, pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Write the pages into new archives in the shared folder and read them back."""
    kind = pages.schema[page_id].dataType
    found = read(write(pages, f"{shared_dir(spark)}/warc", page_id)).where("kind <> 'gap'")
    return found.select(
        F.col("id").cast(kind).alias(page_id), "payload_bytes", "payload_digest",
        F.col("kind").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"))


#: The same in DuckDB's SQL.
SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id <> first THEN first END AS refers_to
FROM f
"""
