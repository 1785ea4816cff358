"""WARC records in ZIP-packaged archives: a writer, and a reader that needs no extraction.

An archive is a ZIP file with two stored members: the WARC records, each a gzip member of its own as usual, and an index of
their offsets and lengths.
The reader takes the end-of-directory record (and its ZIP64 form, where a count or offset doesn't fit) from the file's
tail, parses the central directory, finds the members' bytes through their local headers, reads the index member, and
range-reads the records it names. Archives are read as blocks of records, so one large archive is many tasks' work.

Of equal payloads of at least `min_payload` bytes the one with the largest page id is written as a response, all
others as revisits that name it; smaller payloads are responses. A revisit's block holds the HTTP header only, whose
Content-Length is the full payload's. Payloads are told apart by SHA-256; the largest id of each is
found by an aggregate that combines before the shuffle, and the join back is a sort-merge join, which splits hot payloads.

Files go through pyarrow's file systems (local, HDFS, S3, GCS), under names that no other attempt of a task uses; the
table of archives, committed by Spark, says which of them count.

Defined cases: null html = empty payload; a null page id is kept, as null; repeated rows get a record each, and those of
the largest id are all responses; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of records after which a task starts another archive; records and bytes of one read task's block.
ARCHIVE_BYTES, BLOCK_RECORDS, BLOCK_BYTES, LEVEL = 64 << 20, 512, 8 << 20, 3
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# Writing


class _Sink:
    """A stream without seek, so that the ZIP writer appends sizes and checksums after the data."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def write(self, data) -> int:
        self.stream.write(data)
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        self.stream.flush()


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _shown(page_id) -> str:
    """An id as a part of a record's name; empty for none. (So an id that is an empty text reads back as none.)"""
    return "" if page_id is None else quote(str(page_id), safe="")


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id, url: str | None, payload: bytes, refers_to, serial: str) -> bytes:
    """One WARC record. refers_to: the response's page id if it is a revisit, else None."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{_shown(page_id)}:{serial}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        *([f"WARC-Target-URI: {_clean(url)}"] if url else []),
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{_shown(refers_to)}>"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """One archive: records as they come, then the index."""

    def __init__(self, system: pafs.FileSystem, path: str):
        self.system, self.path, self.index = system, path, []
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.stream = system.open_output_stream(f"{path}.part")
        self.zip = zipfile.ZipFile(_Sink(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member, self.at = self.zip.open(DATA, "w", force_zip64=True), 0

    def add(self, data: bytes) -> None:
        data = gzip.compress(data, LEVEL, mtime=0)
        self.member.write(data)
        self.index.append((self.at, len(data)))
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(INDEX, "w") as member:
            for at, length in self.index:
                member.write(json.dumps({"offset": at, "length": length}).encode() + b"\n")
        self.zip.close()
        self.stream.close()
        self.system.move(f"{self.path}.part", self.path)


def _write(folder: str, archive_bytes: int):
    def run(batches):
        system, base = pafs.FileSystem.from_uri(folder)
        task, n = TaskContext.get(), 0
        writer, paths = None, []
        for batch in batches:
            ids, urls, texts, winners = (batch.column(i).to_pylist() for i in range(4))
            for page_id, url, html, winner in zip(ids, urls, texts, winners):
                if writer is None:
                    path = f"{base}/pages-{task.partitionId():06d}-{len(paths):04d}-{uuid.uuid4().hex}.zip"
                    writer = ArchiveWriter(system, path)
                    paths.append(f"{folder}/{path.rpartition('/')[2]}")
                writer.add(record(page_id, url, (html or "").encode(), winner, f"{task.partitionId()}.{n}"))
                n += 1
                if writer.at >= archive_bytes:
                    writer.close()
                    writer = None
        if writer:
            writer.close()
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths)], ["path"])

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", min_payload: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows' records into archives under folder (a URI); (path) of each archive, as a table."""
    common.bound_batches(pages.sparkSession)
    html = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumn("digest", F.unhex(F.sha2("html", 256)))
    largest = rows.groupBy("digest").agg(F.max("id").alias("largest"))
    winner = F.when((F.octet_length("html") >= min_payload) & ~F.col("id").eqNullSafe(F.col("largest")), F.col("largest"))
    named = rows.join(largest.hint("merge"), "digest").select("id", "url", "html", winner.alias("winner"))
    return common.materialize(named.mapInArrow(_write(folder, archive_bytes), "path string"), "archives")


# Reading


class RangeReader:
    """Reads of byte ranges of one file."""

    def __init__(self, uri: str):
        system, path = pafs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def read(self, at: int, length: int) -> bytes:
        if at < 0 or at + length > self.size:
            raise ValueError(f"range {at}+{length} is outside the file's {self.size} bytes")
        return self.file.read_at(length, at)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def directory(reader) -> dict[str, tuple[int, int, int]]:
    """name -> (method, offset of the local header, stored size), from the central directory."""
    tail_at = max(0, reader.size - 65557)
    tail = reader.read(tail_at, reader.size - tail_at)
    end = len(tail)
    while True:
        end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("no end-of-directory record: not a ZIP file")
        if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
    entries, size, at = struct.unpack_from("<HII", tail, end + 10)
    if entries == 0xFFFF or size == 0xFFFFFFFF or at == 0xFFFFFFFF:
        mark, _, big_at, _ = struct.unpack("<4sIQI", reader.read(tail_at + end - 20, 20))
        if mark != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        big = reader.read(big_at, 56)
        if big[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end-of-directory record")
        entries, size, at = struct.unpack_from("<QQQ", big, 32)
    listing, found, p = reader.read(at, size), {}, 0
    for _ in range(entries):
        if listing[p : p + 4] != b"PK\x01\x02":
            raise ValueError("bad central directory entry")
        method = struct.unpack_from("<H", listing, p + 10)[0]
        stored, plain, names, extras, comments = struct.unpack_from("<IIHHH", listing, p + 20)
        offset = struct.unpack_from("<I", listing, p + 42)[0]
        name = listing[p + 46 : p + 46 + names].decode()
        q, stop = p + 46 + names, p + 46 + names + extras
        while q + 4 <= stop:
            tag, length = struct.unpack_from("<HH", listing, q)
            if tag == 1:  # the fields that don't fit, in this order
                r = q + 4
                if plain == 0xFFFFFFFF:
                    plain, r = struct.unpack_from("<Q", listing, r)[0], r + 8
                if stored == 0xFFFFFFFF:
                    stored, r = struct.unpack_from("<Q", listing, r)[0], r + 8
                if offset == 0xFFFFFFFF:
                    offset = struct.unpack_from("<Q", listing, r)[0]
            q += 4 + length
        found[name] = (method, offset, stored)
        p = stop + comments
    return found


def member_range(reader, entry: tuple[int, int, int]) -> tuple[int, int]:
    """(offset, length) of a stored member's bytes in the file."""
    method, offset, stored = entry
    if method != 0:
        raise ValueError("only stored members can be range-read")
    head = reader.read(offset, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("bad local header")
    names, extras = struct.unpack_from("<HH", head, 26)
    return offset + 30 + names + extras, stored


def _blocks(batches):
    """Of each archive, blocks of record ranges, with offsets in the file."""
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            with RangeReader(uri) as reader:
                members = directory(reader)
                base, size = member_range(reader, members[DATA])
                ranges = [(x["offset"], x["length"]) for x in map(json.loads, reader.read(*member_range(reader, members[INDEX])).splitlines())]
            if any(at + length > size for at, length in ranges):
                raise ValueError(f"{uri}: the index points outside of its member")
            block, held = [], 0
            for at, length in ranges:
                block.append((base + at, length))
                held += length
                if len(block) >= BLOCK_RECORDS or held >= BLOCK_BYTES:
                    yield _block(uri, block)
                    block, held = [], 0
            if block:
                yield _block(uri, block)


def _block(uri: str, ranges: list[tuple[int, int]]) -> pa.RecordBatch:
    at, lengths = zip(*ranges)
    return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([list(at)], pa.list_(pa.int64())), pa.array([list(lengths)], pa.list_(pa.int64()))], ["path", "at", "lengths"])


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields, in lower case, and the block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields, rest[: int(fields["content-length"])]


def read_record(data: bytes) -> tuple[str, int, str, str, str]:
    """(page id, payload bytes, digest, type, page id that it refers to); ids as text, empty if there is none."""
    fields, block = parse(data)
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(v) for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")) if k.lower() == "content-length")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError("a payload doesn't match its digest")
    refers = unquote(fields.get("warc-refers-to", "").removeprefix("<urn:x-page:").removesuffix(">"))
    return unquote(fields["warc-record-id"].split(":")[2]), length, digest, fields["warc-type"], refers


def _records(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, at, lengths in zip(*(batch.column(i).to_pylist() for i in range(3))):
            with RangeReader(uri) as reader:
                rows = [read_record(gzip.decompress(reader.read(a, n))) for a, n in zip(at, lengths)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["id", "bytes", "digest", "type", "refers"])


def read_archives(archives: DataFrame, tasks: int | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), ids as text, of all records of (path)."""
    spark = archives.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = archives.select("path").repartition(tasks, "path").mapInArrow(_blocks, "path string, at array<long>, lengths array<long>")
    # blocks are small rows: dealing them out evens the reading, however large an archive is
    return blocks.repartition(tasks).mapInArrow(_records, "id string, bytes long, digest string, type string, refers string").select(
        F.when(F.col("id") != "", F.col("id")).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(F.col("refers") != "", F.col("refers")).alias("refers_to"),
    )


def warc_round_trip(pages: DataFrame, folder: str | None = None, min_payload: int = 0) -> DataFrame:
    """Write the pages' archives and read them back; ids with the type that they had."""
    id_type = dict(pages.dtypes)["page_id"]
    folder = folder or common.scratch_path(pages.sparkSession, "warc")
    rows = read_archives(write_archives(pages, folder, min_payload=min_payload))
    return rows.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def op4_warc_zip(spark, sf_dir: str) -> DataFrame:
    return warc_round_trip(common.table(spark, sf_dir, "pages"))


_CHAR = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 5 * i + 1, 5))::BIGINT >> {shift}) & 31)::INT, 1)"
SQL = {
    "op4_warc_zip": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT h, string_agg({' || '.join(_CHAR.format(shift=s) for s in (15, 10, 5, 0))}, '' ORDER BY i) AS digest
  FROM (SELECT DISTINCT h FROM p), range(8) r(i) GROUP BY h
),
w AS (SELECT html, max(page_id) AS largest FROM p GROUP BY html)
SELECT p.page_id, strlen(p.html) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN p.page_id = w.largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id = w.largest THEN NULL ELSE w.largest END AS refers_to
FROM p JOIN d USING (h) JOIN w USING (html)
"""
}
