import hashlib
import io
import zipfile
from collections import defaultdict

import pytest

from quarry.llm import warc
from quarry.session import scratch_path
from tests.conftest import SF_CHECK


def brute(rows):
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        ids = [x for x in groups[p] if x is not None]
        last = max(ids) if ids and len(p) >= 1000 and len(groups[p]) > 1 else None
        to = last if last is not None and i != last else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


BIG = "<p>é</p>" * 400
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (4, "http://a/4\r\nX: y z", None), (5, "u", ""), (6, "u", "x" * 999), (7, "u", "x" * 999),
        (8, "u", "x" * 1000), (9, "u", "x" * 1000), (9, "u", "x" * 1000), (None, "u", BIG), (None, "u", "y" * 2000), (None, "u", "y" * 2000), (10, "u", "z" * 3_000_000),
        (-1, "u", "\r\n\r\nPK\x05\x06 \x00 WARC/1.1\r\n" * 90)]


def test_awkward_pages(spark):
    df = spark.createDataFrame([(*r, 1, "d") for r in ROWS], "page_id long, url string, html string, size int, digest string").repartition(3)
    back = warc.roundtrip(df)
    assert result(back) == brute(ROWS)
    payload = {r.page_id: bytes(r.payload) for r in back.where("page_id is not null and payload is not null").collect()}
    assert payload[10] == b"z" * 3_000_000 and payload[3] == BIG.encode() and payload[4] == b""
    assert warc.roundtrip(df.limit(0)).count() == 0


def test_packages_split_and_are_zip_files(spark):
    path = scratch_path(spark, "warc-test-split")
    warc.write_packages(spark.read.parquet(f"{SF_CHECK}/pages.parquet"), path, package_bytes=50_000)
    files = spark.read.format("binaryFile").load(path).where("length > 0").collect()
    assert len(files) > 5
    for f in files:
        z = zipfile.ZipFile(io.BytesIO(bytes(f.content)))
        assert z.testzip() is None and set(z.namelist()) == {warc.ARCHIVE, warc.INDEX, "datapackage.json"} and z.comment == b"\n"


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("comment", [b"", b"\n", b"PK\x05\x06 in a comment" + b"x" * 40])
def test_directory(zip64, comment):
    records = [({"page": i}, warc.record(i, "u", hashlib.sha1(b"p" * i).hexdigest(), i, b"p" * i, None)) for i in range(50)]
    data = warc.package(records, comment, zip64)
    asked = []

    def read(at, n):
        asked.append(n)
        assert 0 <= at and at + n <= len(data)
        return data[at:at + n]
    assert [warc.parse(r)["page_id"] for r in warc.records_of(read, len(data))] == list(range(50))


def test_zip64_directory_fields():
    """A directory whose 32-bit fields all overflow: sizes, offset, counts."""
    import struct
    plain = warc.package([({"page": 1}, warc.record(1, "u", hashlib.sha1(b"ab").hexdigest(), 2, b"ab", None))], b"")
    inside = warc.members(lambda at, n: plain[at:at + n], len(plain))
    at = plain.rfind(warc.EOCD)
    start, body = struct.unpack_from("<I", plain, at + 16)[0], b""
    for name, (header, length, _) in inside.items():
        extra = struct.pack("<HHQQQ", 1, 24, length, length, header)
        body += struct.pack("<4sHHHHHHIIIHHHHHII", warc.CENTRAL, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name.encode() + extra
    end64 = struct.pack("<4sQHHIIQQQQ", warc.EOCD64, 44, 45, 45, 0, 0, 3, 3, len(body), start)
    locator = struct.pack("<4sIQI", warc.LOCATOR64, 0, start + len(body), 1)
    wide = plain[:start] + body + end64 + locator + struct.pack("<4sHHHHIIH", warc.EOCD, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    read = lambda at, n: wide[at:at + n]
    assert warc.members(read, len(wide)) == inside
    assert [warc.parse(r)["payload"] for r in warc.records_of(read, len(wide))] == [b"ab"]


def test_damage_is_reported():
    data = warc.package([({"page": 1}, warc.record(1, "u", "0" * 40, 2, b"ab", None))])
    with pytest.raises(ValueError, match="differ"):
        warc.parse(next(warc.records_of(lambda at, n: data[at:at + n], len(data))))
    with pytest.raises(ValueError, match="end of central directory"):
        warc.members(lambda at, n: data[at:at + n][:n], len(data) - 30)


def test_query(spark):
    from quarry.llm.queries import QUERIES
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_CHECK}/pages.parquet").select("page_id", "url", "html").collect()]
    assert result(QUERIES["op5_warc"](spark, SF_CHECK)) == brute(rows)
