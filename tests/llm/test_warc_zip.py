import base64
import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from passagemill.llm import warc_zip

SCHEMA = "page_id long, url string, html string"


class Bytes:
    def __init__(self, data):
        self.data, self.size = data, len(data)

    def read(self, at, length):
        return self.data[at : at + length]


def archive(members, comment=b"", compression=zipfile.ZIP_STORED):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", compression) as z:
        for name, data in members.items():
            z.writestr(name, data)
        z.comment = comment
    return buffer.getvalue()


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 looks like an end record but is a comment"])
def test_directory_and_ranges(comment):
    data = archive({"a": b"first", "dir/b": b"\x00" * 1000, "c": b""}, comment)
    reader = Bytes(data)
    found = warc_zip.directory(reader)
    got = {k: reader.read(*warc_zip.member_range(reader, v)) for k, v in found.items()}
    assert got == {"a": b"first", "dir/b": b"\x00" * 1000, "c": b""}


def test_zip64_directory():
    data = archive({"x": b"payload", "y": b"other"})
    end = data.rfind(b"PK\x05\x06")
    n, size, at = struct.unpack_from("<HII", data, end + 10)
    listing, fixed, p = data[at : at + size], b"", 0
    for _ in range(n):  # move sizes and offsets into ZIP64 extra fields
        stored, plain, names = struct.unpack_from("<IIH", listing, p + 20)
        offset = struct.unpack_from("<I", listing, p + 42)[0]
        extra = struct.pack("<HHQQQ", 1, 24, plain, stored, offset)
        head = bytearray(listing[p : p + 46])
        struct.pack_into("<IIHH", head, 20, 0xFFFFFFFF, 0xFFFFFFFF, names, len(extra))
        struct.pack_into("<I", head, 42, 0xFFFFFFFF)
        fixed += bytes(head) + listing[p + 46 : p + 46 + names] + extra
        p += 46 + names
    big = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, len(fixed), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(fixed), 1)
    tail = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    reader = Bytes(data[:at] + fixed + big + locator + tail)
    found = warc_zip.directory(reader)
    assert {k: reader.read(*warc_zip.member_range(reader, v)) for k, v in found.items()} == {"x": b"payload", "y": b"other"}


def test_broken_and_compressed_archives():
    with pytest.raises(ValueError):
        warc_zip.directory(Bytes(b"not a zip"))
    reader = Bytes(archive({"a": b"z" * 99}, compression=zipfile.ZIP_DEFLATED))
    with pytest.raises(ValueError):
        warc_zip.member_range(reader, warc_zip.directory(reader)["a"])


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [
    (1, "http://a/\r\nX: y", "<p>é😀\r\n\r\nWARC/1.1\r\n</p>"),
    (2, None, None),
    (3, "http://b", ""),
    (4, "http://c", "same"),
    (9, "http://d", "same"),
    (7, "http://e", "same"),
    (10, "http://f", "x" * 300_000),
    (11, "http://g", "Same"),
]


@pytest.mark.parametrize("archive_bytes", [1, 1000, 1 << 26])
def test_round_trip(spark, tmp_path, archive_bytes):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    archives = warc_zip.write_archives(df, f"file://{tmp_path}/w", archive_bytes=archive_bytes)
    got = {int(r.page_id): tuple(r)[1:] for r in warc_zip.read_archives(archives).collect()}
    largest = {}
    for i, _, h in PAGES:
        largest[h or ""] = max(i, largest.get(h or "", 0))
    for i, _, h in PAGES:
        top = largest[h or ""]
        assert got[i] == (len((h or "").encode()), sha(h), *(("response", None) if i == top else ("revisit", str(top))))
    for row in archives.collect():  # other readers can open them
        with zipfile.ZipFile(row.path.removeprefix("file://")) as z:
            assert z.testzip() is None and z.namelist() == [warc_zip.DATA, warc_zip.INDEX]


def test_odd_tables(spark):
    assert warc_zip.warc_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(None, "u", "q"), (5, "u", "q"), (5, "u", "q")], SCHEMA).withColumn("digest", F.lit(1)).withColumn("path", F.lit(2))
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc_zip.warc_round_trip(df).collect())
    assert got == [("5", "response", None), ("5", "response", None), ("None", "revisit", 5)]
    small = warc_zip.warc_round_trip(spark.createDataFrame([(1, "u", "q"), (2, "u", "q")], SCHEMA), min_payload=2)
    assert {r.record_type for r in small.collect()} == {"response"}


def test_ids_that_are_texts(spark):
    rows = [("a:b", "u", "q"), ("ü >\r\nX: y", "u", "q"), ("%3A", "u", "r")]
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc_zip.warc_round_trip(spark.createDataFrame(rows, SCHEMA.replace("page_id long", "page_id string"))).collect()}
    assert got == {"a:b": ("revisit", "ü >\r\nX: y"), "ü >\r\nX: y": ("response", None), "%3A": ("response", None)}
