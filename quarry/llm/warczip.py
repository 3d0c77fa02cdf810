"""WARC records in ZIP packages, read by ranges.

A package is a ZIP of stored members, after the layout of web-archive bundles:
``archive/data.warc.gz`` holds a gzip member for each record,
``indexes/index.cdxj`` a line for each record with its place in that file.
The reader parses the end record, the ZIP64 records and the central directory,
finds where a stored member's bytes lie, and reads records straight from the
package by (offset, length); nothing is unpacked to disk or read twice.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, split_batch
from quarry.llm.store import locate, new_file, new_folder, spread

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
LEAST = 1000  # payload bytes from which equal ones become revisits
PAGE_URN = "urn:page:"


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int


class ZipReader:
    """Members of a ZIP file behind a seekable, readable object."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        self.size = file.tell()
        self.members = {m.name: m for m in self._directory()}
        self._starts: dict[str, int] = {}

    def read_at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the package is cut short")
        return data

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - 0xFFFF)
        tail = self.read_at(tail_at, self.size - tail_at)
        at = len(tail) - 22
        while at >= 0 and not (tail[at: at + 4] == b"PK\5\6" and struct.unpack_from("<H", tail, at + 20)[0] == len(tail) - at - 22):
            at = tail.rfind(b"PK\5\6", 0, at + 3) if at else -1
        if at < 0:
            raise ValueError("no end of central directory")
        count, size, start = struct.unpack_from("<HII", tail, at + 10)
        end = tail_at + at
        if end >= 20 and self.read_at(end - 20, 4) == b"PK\6\7":
            record = self.read_at(struct.unpack("<Q", self.read_at(end - 12, 8))[0], 56)
            if record[:4] != b"PK\6\6":
                raise ValueError("broken ZIP64 end record")
            count, size, start = struct.unpack_from("<QQQ", record, 32)
        data, p = self.read_at(start, size), 0
        for _ in range(count):
            if data[p: p + 4] != b"PK\1\2":
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", data, p + 8)
            packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, p + 20)
            header = struct.unpack_from("<I", data, p + 42)[0]
            name = data[p + 46: p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[p + 46 + n_name: p + 46 + n_name + n_extra]
            plain, packed, header = _zip64(extra, plain, packed, header)
            yield Member(name, method, plain, packed, header)
            p += 46 + n_name + n_extra + n_comment

    def start(self, name: str) -> int:
        """Where the bytes of a stored member begin."""
        if name not in self._starts:
            m = self.members[name]
            if m.method != zipfile.ZIP_STORED:
                raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
            local = self.read_at(m.header, 30)
            if local[:4] != b"PK\3\4":
                raise ValueError("broken local header")
            self._starts[name] = m.header + 30 + sum(struct.unpack_from("<HH", local, 26))
        return self._starts[name]

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        """A range of a stored member's bytes."""
        left = self.members[name].size - offset
        length = left if length is None else length
        if offset < 0 or length < 0 or length > left:
            raise ValueError(f"range outside {name}")
        return self.read_at(self.start(name) + offset, length)


def _zip64(extra: bytes, plain: int, packed: int, header: int) -> tuple[int, int, int]:
    """Sizes and offset with those that the ZIP64 extra field replaces."""
    p = 0
    while p + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, p)
        if kind == 1:
            q, out = p + 4, []
            for v in (plain, packed, header):
                if v == 0xFFFFFFFF:
                    v, q = struct.unpack_from("<Q", extra, q)[0], q + 8
                out.append(v)
            return tuple(out)
        p += 4 + n
    return plain, packed, header


# Records

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """A WARC record in a gzip member of its own; a revisit has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + payload if refers_to is None else http
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<{PAGE_URN}{'' if page_id is None else page_id}>",
            "WARC-Target-URI": "".join(c for c in url or "" if c >= " "), "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<{PAGE_URN}{refers_to}>"}
    head["Content-Length"] = str(len(block))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress(text.encode() + block + b"\r\n\r\n") + press.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and payload of a gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    warc = _headers(lines)
    size = int(warc["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("broken record")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _headers(http.decode().split("\r\n")[1:]), payload


def _headers(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page_id(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(PAGE_URN)
    return int(number) if number else None


class PackageWriter:
    """Streams records into a package; the index follows when it is closed."""

    def __init__(self, stream):
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.stream, self.lines, self.at = stream, [], 0

    def add(self, page_id: int | None, url: str | None, data: bytes) -> None:
        self.member.write(data)
        self.lines.append(f"{page_id} {json.dumps({'url': url, 'offset': self.at, 'length': len(data)})}\n")
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(INDEX, "".join(self.lines))
        self.zip.close()
        self.stream.close()


class PackageReader(ZipReader):
    """Records of a package by its index."""

    def index(self) -> list[tuple[int, int]]:
        """(offset, length) of every record, in order."""
        entries = (json.loads(x.split(" ", 1)[1]) for x in self.read(INDEX).decode().splitlines())
        return [(e["offset"], e["length"]) for e in entries]

    def scan(self, block: int = 4 << 20) -> Iterator[tuple]:
        """All records, fetched in ranges of about ``block`` bytes."""
        places, k = self.index(), 0
        while k < len(places):
            first, stop = places[k][0], k + 1
            while stop < len(places) and sum(places[stop]) - first <= block:
                stop += 1
            data = self.read(ARCHIVE, first, sum(places[stop - 1]) - first)
            for at, n in places[k:stop]:
                yield parse_record(data[at - first: at - first + n])
            k = stop


# Jobs

def records(pages: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(page_id, url, payload, digest, size) of every row, and the largest
    ``page_id`` of each payload of ``least`` bytes or more that several rows
    share. Equal means same length and SHA-1."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    return rows, rows.where(F.col("size") >= least).groupBy("digest", "size").agg(
        F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1 and top is not null").select(
        F.col("digest").alias("top_digest"), F.col("size").alias("top_size"), "top")


MANIFEST = "part int, file string, records bigint"


def write(pages: DataFrame, scratch: Scratch, least: int = LEAST) -> DataFrame:
    """Write a record for each row of ``pages(page_id, url, html)``, a package
    a task; returns the manifest.

    A null html is an empty payload. A header holds one line, so a URL loses its
    control characters and the blanks around it, and a null one is read back as
    empty. Rows that share the largest ``page_id`` of
    their payload are all responses, so are rows of payloads whose ids are all
    null; a null id below another is a revisit. Other columns are ignored; an
    empty table makes no package.
    """
    rows, tops = records(pages, least)
    tops = scratch.write(tops, "tops")
    rows = rows.join(tops, (F.col("digest") == F.col("top_digest")) & (F.col("size") == F.col("top_size")), "left")
    below = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    rows = rows.withColumn("refers_to", F.when(below, F.col("top"))).select("page_id", "url", "payload", "digest", "size", "refers_to", F.spark_partition_id().alias("part"))
    folder = new_folder(pages.sparkSession, f"{scratch.name}-packages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for piece in split_batch(batch, "payload", 8 << 20):
                if writer is None:
                    part = piece.column(6)[0].as_py()
                    file = new_file(folder, f"part-{part:05d}", ".wacz")
                    system, path = locate(file)
                    writer = PackageWriter(system.open_output_stream(path, compression=None))
                for page_id, url, payload, digest, size, refers_to, _ in zip(*(c.to_pylist() for c in piece.columns)):
                    writer.add(page_id, url, record(page_id, url, payload, digest, size, refers_to))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([file]), pa.array([len(writer.lines)], pa.int64())], names=["part", "file", "records"])

    return scratch.write(rows.mapInArrow(run, MANIFEST), "manifest")


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"


def read(manifest: DataFrame) -> DataFrame:
    """Every record of the packages. Length and digest of a response are those
    of the payload read back, and must be as its headers say; a revisit has
    them from its headers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, path = locate(file)
                with system.open_input_file(path) as f:
                    rows = []
                    for warc, http, payload in PackageReader(f).scan():
                        rows.append(_row(warc, http, payload))
                        if len(rows) == 4096:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    return spread(manifest).select("file").mapInArrow(run, READ)


def _row(warc: dict, http: dict, payload: bytes) -> tuple:
    size, digest = int(http["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:")
    if warc["warc-type"] == "response":
        found = len(payload), hashlib.sha1(payload).hexdigest()
        if found != (size, digest):
            raise ValueError(f"payload of {warc['warc-record-id']} is damaged")
        size, digest = found
    return _page_id(warc["warc-record-id"]), size, digest, warc["warc-type"], _page_id(warc.get("warc-refers-to")), warc["warc-target-uri"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in READ.split(", ")])
