"""Records written and read back, ZIP64 directories, damaged archives."""

import gzip
import hashlib
import io
import os
import struct
import zipfile

import pyarrow as pa
import pytest

from ludoscope.llm import archives


def read_zip(raw):
    return archives.ZipReader(pa.BufferReader(raw))


def test_stored_members_are_found_behind_other_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("packed.txt", "x" * 1000, zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("größ.bin"), "w", force_zip64=True) as f:
            f.write(b"payload" * 99)
        z.comment = b"a comment with PK\x05\x06 inside it"[:10]
    archive = read_zip(out.getvalue())
    at, n = archive.stored_at("größ.bin")
    assert out.getvalue()[at : at + n] == b"payload" * 99
    with pytest.raises(ValueError):
        archive.stored_at("packed.txt")


def test_zip64_directory():
    """A directory whose counts, sizes and offsets are all in the ZIP64 records."""
    name, body = b"data.bin", b"stored bytes"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(body), len(body))
    extra = struct.pack("<HHB", 0x7777, 1, 0) + struct.pack("<HHQQQ", 1, 24, len(body), len(body), 5)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    head = b"junk!" + local + body
    big = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), len(head))
    raw = head + entry + big + struct.pack("<4sIQI", b"PK\x06\x07", 0, len(head) + len(entry), 1) + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    archive = read_zip(raw)
    at, n = archive.stored_at("data.bin")
    assert raw[at : at + n] == body
    for cut in (10, len(raw) - 1):
        with pytest.raises(ValueError):
            read_zip(raw[:cut])


def test_pages_come_back(spark):
    long = "<p>é" + "x" * 200
    rows = [(5, "http://a/ü?x=1\r\nEvil: 1", long, 1), (2, None, long, 1), (9, "http://b", long, 1), (3, "u", "short", 1), (1, "u", "short", 1), (7, "u", None, 1), (8, "u", "", 1),
            (None, "n", long, 1), (2, "again", long, 1), (None, "n", "y" * 100, 1), (11, "z", "z" * 5_000_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    packages = archives.write_archives(pages, package_bytes=200)
    got = archives.read_archives(packages).collect()
    assert len(got) == len(rows) and sum(r["records"] for r in packages.collect()) == len(rows)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0, r["payload_bytes"]) for r in got)
    n = len(long.encode())
    assert kinds == sorted([(5, "revisit", 2, n), (2, "response", 0, n), (2, "response", 0, n), (9, "revisit", 2, n), (3, "response", 0, 5), (1, "response", 0, 5),
                            (7, "response", 0, 0), (8, "response", 0, 0), (0, "revisit", 2, n), (0, "response", 0, 100), (11, "response", 0, 5_000_000)])
    texts = {hashlib.sha256((h or "").encode()).hexdigest(): h or "" for _, _, h, _ in rows}
    for r in got:
        assert r["payload_bytes"] == len(texts[r["payload_digest"]].encode())
        if r["record_type"] == "response":
            assert r["payload"].decode() == texts[r["payload_digest"]]
    # Any ZIP reader can open a package, and each record is a gzip member of its own.
    path = packages.first()["archive"].removeprefix("file:")
    with zipfile.ZipFile("/" + path.lstrip("/")) as z:
        assert z.testzip() is None and gzip.decompress(z.read(archives.DATA)).startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert archives.read_archives(archives.write_archives(pages.limit(0))).count() == 0


def test_a_damaged_payload_is_an_error():
    record = archives.warc_record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None)
    assert archives.parse_record(record)["payload"] == b"hello"
    with pytest.raises(ValueError):
        archives.parse_record(record.replace(b"hello", b"hullo"))


def test_uris():
    assert archives.open_store("file:///a/b%20c")[1] == "/a/b c" and archives.open_store("/a/b")[1] == "/a/b" and archives.open_store("file:/a")[1] == "/a"
    assert os.sep == "/"


@pytest.mark.parametrize("uri, mapped", [
    ("s3a://bucket/a b/x.zip", "s3://bucket/a b/x.zip"), ("s3n://b/x", "s3://b/x"), ("s3://b/x", "s3://b/x"), ("S3A://b/x", "s3://b/x"), ("hdfs://host:8020/x", "hdfs://host:8020/x"),
    ("gcs://b/x", "gs://b/x"), ("file:/tmp/x", "file:/tmp/x"), ("/tmp/x", "/tmp/x"),
])
def test_schemes(uri, mapped):
    assert archives.store_uri(uri) == mapped


def test_unknown_schemes_are_refused_before_the_job(spark, monkeypatch):
    with pytest.raises(ValueError, match="nowhere"):
        archives.store_uri("nowhere://b/x")
    monkeypatch.setattr(archives, "scratch_path", lambda *a: "nowhere://b/x")
    with pytest.raises(ValueError):
        archives.write_archives(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string"))
