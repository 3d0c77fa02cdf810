import hashlib
import io
import zipfile

import pytest

from quarry.llm import warczip
from quarry.llm.common import Scratch


class Stream(io.RawIOBase):
    """Write-only, as an object store's."""

    def __init__(self):
        self.data = bytearray()

    def writable(self):
        return True

    def write(self, b):
        self.data += b
        return len(b)

    def close(self):
        pass


def package(records):
    out = Stream()
    w = warczip.PackageWriter(out)
    for r in records:
        payload = r[2]
        w.add(r[0], r[1], warczip.record(r[0], r[1], payload, hashlib.sha1(payload).hexdigest(), len(payload), r[3]))
    w.close()
    return bytes(out.data)


class Counting(io.BytesIO):
    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


def test_package_is_a_zip_and_records_are_read_by_ranges():
    import random

    rng = random.Random(0)
    records = [(i, f"http://h/{i}", rng.randbytes(rng.randrange(9000)), 3 if i == 7 else None) for i in range(500)]
    data = package(records)
    z = zipfile.ZipFile(io.BytesIO(data))
    assert z.testzip() is None and z.namelist() == [warczip.ARCHIVE, warczip.INDEX]
    f = Counting(data)
    r = warczip.PackageReader(f)
    places = r.index()
    f.got = 0
    warc, http, payload = warczip.parse_record(r.read(warczip.ARCHIVE, *places[400]))
    assert payload == records[400][2] and warc["warc-type"] == "response" and f.got < places[400][1] + 100
    got = list(r.scan(20_000))
    assert [p for _, _, p in got] == [b"" if x[3] is not None else x[2] for x in records]
    assert got[7][0]["warc-type"] == "revisit" and got[7][0]["warc-refers-to"] == "<urn:page:3>"
    with pytest.raises(ValueError):
        r.read(warczip.ARCHIVE, 5, len(data))
    with pytest.raises(ValueError):
        warczip.ZipReader(io.BytesIO(data[:-30]))


def test_zip64_comments_and_compressed_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(66_000):
            z.writestr(f"m{i}", b"%d" % i)
        z.writestr("packed", b"x" * 999, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"PK\5\6 not the end"
    r = warczip.ZipReader(io.BytesIO(out.getvalue()))
    assert len(r.members) == 66_001 and r.read("m65999") == b"65999" and r.read("m65999", 2, 2) == b"99"
    with pytest.raises(ValueError):
        r.read("packed")
    extra = warczip._zip64(b"\x99\x99\2\0ab" + b"\1\0\x18\0" + (5).to_bytes(8, "little") + (6).to_bytes(8, "little") + (2**33).to_bytes(8, "little"), 0xFFFFFFFF, 0xFFFFFFFF, 0xFFFFFFFF)
    assert extra == (5, 6, 2**33)
    empty = io.BytesIO()
    zipfile.ZipFile(empty, "w").close()
    assert warczip.ZipReader(empty).members == {}


def test_pages(spark):
    long, other = "<p>é</p>" * 200, "<b>" * 400
    rows = [(1, "http://a", long), (5, "http://b\n", long), (9, None, long), (9, None, long), (2, "u", "short"), (3, "u", "short"), (4, "u", None), (6, "u", ""),
            (None, "u", long), (None, "u", other), (None, "u", other), (7, "u", "z" * 300_000), (8, "u", "\r\n\r\n" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as size", "'x' as payload", "2 as part")
    got = warczip.read(warczip.write(pages.repartition(3), Scratch(spark, "t"))).collect()
    want = []
    for i, _, html in rows:
        b = (html or "").encode()
        top = 9 if html == long and i != 9 else None
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if top else "response", top))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert warczip.read(warczip.write(pages.limit(0), Scratch(spark, "t"))).count() == 0
