"""WARC records in ZIP packages: written per partition with an index, read back by range from the archive's directories.

A package holds two stored members: ``archive/data.warc.gz``, one gzip member per record, and ``indexes/index.cdx``, one line
per record with its offset and length in the first member. The reader finds the central directory from the end of the
file (with the ZIP64 records, where they are), and then reads only the ranges it needs; nothing is extracted.
Files are reached through Arrow's file systems by their URI, so tasks need no local folder.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import struct
import urllib.parse
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, functions as F

from ludoscope.llm.frames import ready
from ludoscope.session import drop_on_exit, scratch_path, stored

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 100
#: A package is closed when its records reach this size, and neighbouring records are read in ranges up to the second.
PACKAGE_BYTES, RANGE_BYTES = 64 << 20, 8 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ZIP64_SIZE = 0xFFFFFFFF


#: Schemes of a shared folder, and what Arrow calls them. ``hdfs`` and ``viewfs`` need Hadoop's native library where tasks run.
SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss", "file": "file", "": "file"}


def store_uri(uri: str) -> str:
    """The URI as Arrow reads it; one without a scheme is a path. Unknown schemes are an error, so ask before a job starts."""
    scheme = uri.split(":", 1)[0].lower() if "://" in uri or uri.startswith("file:") else ""
    if scheme not in SCHEMES:
        raise ValueError(f"packages cannot be kept under {scheme}://; known are {', '.join(k for k in SCHEMES if k)}")
    return f"{SCHEMES[scheme]}{uri[len(scheme) :]}" if scheme else uri


def open_store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system and path of a URI."""
    uri = store_uri(uri)
    parts = urllib.parse.urlsplit(uri)
    if parts.scheme == "file":
        return arrow_fs.LocalFileSystem(), urllib.parse.unquote(parts.path)
    return arrow_fs.FileSystem.from_uri(uri) if "://" in uri else (arrow_fs.LocalFileSystem(), uri)


# --- reading ZIP ---


@dataclass(frozen=True)
class Member:
    """An archive member: its name, method, sizes, and where its local header is."""

    name: str
    method: int
    packed: int
    size: int
    header: int


class ZipReader:
    """Members of a ZIP file that can be read by range."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source = source
        self.length = source.size()
        self.members = {m.name: m for m in self._directory()}

    def read(self, offset: int, n: int) -> bytes:
        """Exactly ``n`` bytes from ``offset`` on."""
        raw = self.source.read_at(n, offset) if n else b""
        if len(raw) != n:
            raise ValueError("the archive ends too early")
        return raw

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.length - 65_557)
        tail = self.read(tail_at, self.length - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0 or len(tail) - end < 22:
            raise ValueError("no end of central directory")
        count, size, start = struct.unpack_from("<HII", tail, end + 10)
        if count == 0xFFFF or _ZIP64_SIZE in (size, start):
            at = tail_at + end - 20
            locator = self.read(at, 20) if at >= 0 else b""
            if locator[:4] == b"PK\x06\x07":
                big = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if big[:4] != b"PK\x06\x06":
                    raise ValueError("no ZIP64 end of central directory")
                count, size, start = struct.unpack_from("<QQQ", big, 32)
        raw, at = self.read(start, size), 0
        for _ in range(count):
            if raw[at : at + 4] != b"PK\x01\x02":
                raise ValueError("a central directory entry is broken")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            packed, full, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", raw, at + 20)
            header = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
            full, packed, header = _zip64_sizes(extra, full, packed, header)
            yield Member(name, method, packed, full, header)
            at += 46 + n_name + n_extra + n_note

    def stored_at(self, name: str) -> tuple[int, int]:
        """Where the bytes of a stored member begin, and how many there are."""
        m = self.members[name]
        if m.method != 0 or m.packed != m.size:
            raise ValueError(f"{name} is not stored")
        head = self.read(m.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} has no local header")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return m.header + 30 + n_name + n_extra, m.size


def _zip64_sizes(extra: bytes, full: int, packed: int, header: int) -> tuple[int, int, int]:
    """Sizes and offset with those taken from the ZIP64 extra field that did not fit 32 bits, in the order it holds them."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            full, packed, header = (next(values) if v == _ZIP64_SIZE else v for v in (full, packed, header))
            break
        at += 4 + n
    return full, packed, header


# --- WARC records ---


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record with the HTTP head only where the payload is that of another page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {urllib.parse.quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """A record's fields: page_id, record_type, refers_to, payload_bytes, payload_digest, payload (null for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    return {
        "page_id": _page(fields["warc-record-id"]), "record_type": kind, "refers_to": _page(fields.get("warc-refers-to", "<urn:page:>")),
        "payload_bytes": length, "payload_digest": digest, "payload": payload if kind == "response" else None,
    }


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


# --- Spark jobs ---


def plan_records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Pages (page_id, url, html) with digest and refers_to: the smallest page_id with the same payload, if it is another one."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    # Only digests that occur again are joined back; counts are summed up before the shuffle.
    again = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    again = again.where("n > 1").select("digest", "first")
    joined = rows.join(again, "digest", "left")
    return joined.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write every row of ``pages`` as a record into packages in the shared folder: a table (archive, records).

    Like all stored tables, packages stay as long as the driver runs; copy those that are to last.
    A task holds one package in memory, of about ``package_bytes`` and one record, and writes it in one go under a name of its own.
    The table is stored, so packages of attempts that failed are in no row of it.
    Null html is an empty payload; payloads of equal text are stored once if they have REVISIT_BYTES or more. Rows repeated
    under one page_id are records of their own. A null page_id is a record without a number, and never one that
    others refer to. Further columns are ignored.
    """
    folder = scratch_path(pages.sparkSession, "archives")
    store_uri(folder)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        data, index = io.BytesIO(), []

        def close() -> pa.RecordBatch:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                z.writestr(DATA, data.getbuffer())
                z.writestr(INDEX, "".join(f"{offset} {length}\n" for offset, length in index))
            name = f"{uuid.uuid4().hex}.wacz"
            store.create_dir(root, recursive=True)
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(out.getbuffer())
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(index)], pa.int64())], names=["archive", "records"])

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to"))):
                page_id, url, html, digest, refers_to = (x.as_py() for x in row)
                packed = gzip.compress(warc_record(page_id, url, html.encode(), digest, refers_to), 3, mtime=0)
                index.append((data.tell(), len(packed)))
                data.write(packed)
                if data.tell() >= package_bytes:
                    yield close()
                    data, index = io.BytesIO(), []
        if index:
            yield close()

    packages = stored(plan_records(ready(pages)).mapInArrow(work, "archive string, records long"), "packages")
    drop_on_exit(pages.sparkSession, folder)
    return packages


def read_archives(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the packages (archive): page_id, payload_bytes, payload_digest, record_type, refers_to (and payload).

    A task reads an archive's directory and index, and then its records in ranges of neighbours. A payload that does not
    match its digest is an error. An empty table of packages gives no records.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payloads else [])]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                store, path = open_store(uri)
                with store.open_input_file(path) as source:
                    archive = ZipReader(source)
                    at, n = archive.stored_at(INDEX)
                    index = [tuple(map(int, line.split())) for line in archive.read(at, n).decode().splitlines()]
                    at, n = archive.stored_at(DATA)
                    for first, last in _ranges(index):
                        low, high = index[first][0], sum(index[last - 1])
                        if high > n:
                            raise ValueError("the index points beyond the archive")
                        raw = archive.read(at + low, high - low)
                        rows = [parse_record(gzip.decompress(raw[o - low : o - low + k])) for o, k in index[first:last]]
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds)], names=names)

    fields = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if payloads else "")
    # One archive is much work, so archives are dealt out evenly instead of file by file.
    n = max(1, packages.count())
    return packages.select("archive").repartition(n).mapInArrow(work, fields)


def _ranges(index: list[tuple[int, ...]]) -> Iterator[tuple[int, int]]:
    """Runs of records that lie within RANGE_BYTES, or single larger ones."""
    first = 0
    for i in range(1, len(index) + 1):
        if i == len(index) or sum(index[i]) - index[first][0] > RANGE_BYTES:
            yield first, i
            first = i
