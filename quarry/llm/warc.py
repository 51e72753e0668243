"""WARC records in ZIP-packaged archives: written, and read back by ranges.

A package is a ZIP file with stored members: ``archive/data.warc.gz`` (one gzip
member per record), ``indexes/index.cdxj`` (offset and length of each record)
and ``datapackage.json``. The reader parses the central directory (ZIP64
included) from the end of the file, finds the stored members, reads the index,
and then reads each record's bytes where they stand; nothing is extracted.

Packages are written by Spark's own file writer into the shared folder, one
package a row and one row a file, so that a failed or repeated task leaves no
half-written package. (The writer ends a row with a line break; it is the
package's one-byte ZIP comment.)
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

from .common import only, text_or_empty

MIN_REVISIT_BYTES = 1000
PACKAGE_BYTES = 16 << 20   # compressed records of a package before the next one begins
READ_BYTES = 4 << 20       # neighbouring records are fetched together up to this
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"  # fixed values: the package layout
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value: the standard's profile

# Signatures and record layouts of the ZIP format.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


# ---- records

def record(page_id, url, digest: str, size: int, payload: bytes | None, refers_to) -> bytes:
    """One WARC record, compressed as a gzip member. payload None: a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if payload is None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def _urn(page_id) -> str:
    return "<urn:page:null>" if page_id is None else f"<urn:page:{page_id}>"


def _page(urn: str | None):
    tail = (urn or "null").rstrip(">").rpartition(":")[2]
    return None if tail == "null" else int(tail)


def parse(data: bytes) -> dict:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest and payload (None for a revisit) of a compressed record.
    A payload that doesn't match its digest or length fails."""
    d = zlib.decompressobj(31)
    raw = d.decompress(data) + d.flush()
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))[15:])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: payload and header differ")
    return {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": _page(fields.get("WARC-Refers-To")) if kind == "revisit" else None,
            "payload_bytes": size, "payload_digest": digest, "payload": payload if kind == "response" else None}


# ---- packages

def package(records: list[tuple[dict, bytes]], comment: bytes = b"\n", zip64: bool = False) -> bytes:
    """A package of (index entry, compressed record) pairs. ``zip64`` forces 64-bit fields (they are used anyway where sizes need them)."""
    index, at = [], 0
    for entry, data in records:
        index.append(json.dumps(entry | {"offset": at, "length": len(data)}, separators=(",", ":")))
        at += len(data)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        z.comment = comment
        members = ((ARCHIVE, (r for _, r in records)), (INDEX, iter(["\n".join(sorted(index)).encode()])),
                   ("datapackage.json", iter([json.dumps({"profile": "data-package", "resources": [{"path": ARCHIVE}, {"path": INDEX}]}).encode()])))
        for name, parts in members:
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                for p in parts:
                    f.write(p)
    return out.getvalue()


def members(read: Callable[[int, int], bytes], size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (offset of the member's header, its length, compression method),
    from the central directory. ``read(offset, length)`` gives bytes of the file."""
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(EOCD)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(EOCD, 0, at)  # the signature inside a comment
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start) or (tail_at + at >= 20 and read(tail_at + at - 20, 4) == LOCATOR64):
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record64[:4] != EOCD64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record64, 32)
    directory, out, at = read(start, length), {}, 0
    for _ in range(count):
        if directory[at:at + 4] != CENTRAL:
            raise ValueError("central directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + name_n:at + 46 + name_n + extra_n]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: the fields that overflowed, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain, packed, header = (next(wide) if v == 0xFFFFFFFF else v for v in (plain, packed, header))
            extra = extra[4 + n:]
        out[name] = (header, packed, method)
        at += 46 + name_n + extra_n + comment_n
    return out


def stored(read: Callable[[int, int], bytes], member: tuple[int, int, int]) -> tuple[int, int]:
    """Where the bytes of a stored member stand: (offset, length)."""
    header, length, method = member
    if method != 0:
        raise ValueError("the member is compressed: its records can't be read by ranges")
    local = read(header, 30)
    if local[:4] != LOCAL:
        raise ValueError("no local header")
    name_n, extra_n = struct.unpack_from("<HH", local, 26)
    return header + 30 + name_n + extra_n, length


def records_of(read: Callable[[int, int], bytes], size: int) -> Iterator[bytes]:
    """Compressed records of a package in index order, fetched by ranges (neighbours together)."""
    inside = members(read, size)
    base, total = stored(read, inside[ARCHIVE])
    at, n = stored(read, inside[INDEX])
    index = sorted(((e["offset"], e["length"]) for e in map(json.loads, read(at, n).splitlines())))
    i = 0
    while i < len(index):
        j = i
        while j + 1 < len(index) and index[j + 1][0] + index[j + 1][1] - index[i][0] <= READ_BYTES:
            j += 1
        first = index[i][0]
        if index[j][0] + index[j][1] > total:
            raise ValueError("an index entry lies outside the archive")
        data = read(base + first, index[j][0] + index[j][1] - first)
        for offset, length in index[i:j + 1]:
            yield data[offset - first:offset - first + length]
        i = j + 1


def open_ranges(path: str):
    """A file that gives byte ranges, from the URI of a file system that Arrow opens (file, HDFS, S3, GCS, Azure)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    where, inner = fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a:") else path)
    return where.open_input_file(inner)


# ---- Spark

def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, size, digest, refers_to (null: a response) and html (null for a revisit)."""
    html = text_or_empty(html_col).cast("binary")
    rows = (only(pages, id_col, url_col, html_col).select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), html.alias("html"))
            .select("page_id", "url", "html", F.octet_length("html").cast("long").alias("size"), F.sha1("html").alias("digest")))
    last = (rows.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("digest", "size", "last"))
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return (rows.join(last, ["digest", "size"], "left").withColumn("refers_to", refers)
            .select("page_id", "url", "size", "digest", "refers_to", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html")))


def write_packages(pages: DataFrame, path: str, package_bytes: int = PACKAGE_BYTES, **names: str) -> None:
    """Write every page as a record into packages below ``path`` (which must not exist)."""

    def pack(batches):
        held, size = [], 0
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                for page_id, url, n, digest, refers_to, html in zip(*(c.to_pylist() for c in b.slice(lo, 200).columns)):
                    data = record(page_id, url, digest, n, html if refers_to is None else None, refers_to)
                    held.append(({"page": page_id, "digest": digest}, data))
                    size += len(data)
                    if size >= package_bytes:
                        yield _one(package(held))
                        held, size = [], 0
        if held:
            yield _one(package(held))

    def _one(data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], names=["package"])  # the writer adds the comment's byte

    packed = with_revisits(pages, **names).mapInArrow(pack, "package binary")
    packed.select(F.col("package").cast("string").alias("package")).write.option("maxRecordsPerFile", 1).text(path)


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest and payload of every record of the packages below ``path``."""
    # only names and lengths: the files are opened by ranges in the tasks
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")

    def read(batches):
        for b in batches:
            for name, size in zip(*(c.to_pylist() for c in b.columns)):
                with open_ranges(name) as f:
                    held: list[dict] = []
                    for data in records_of(lambda at, n: f.read_at(n, at), size):
                        held.append(parse(data))
                        if len(held) >= 200:
                            yield pa.RecordBatch.from_pylist(held, SCHEMA)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pylist(held, SCHEMA)

    # one file is one small row of this frame, too small for a fixed share of bytes to spread: a stated number of tasks does
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def roundtrip(pages: DataFrame, path: str | None = None, **names: str) -> DataFrame:
    """Write the pages as packages into the shared folder and return what is read back.

    A null html is an empty payload. Of records with equal payloads of at least
    MIN_REVISIT_BYTES the one with the largest id is the response (rows repeated
    under that id too), the others, rows without an id included, revisit it;
    without any id in the group, and below that size, all are responses. Empty
    input: no rows.
    """
    path = path or scratch_path(pages.sparkSession, "llm", f"warc-{uuid.uuid4().hex}")
    write_packages(pages, path, **names)
    return read_packages(pages.sparkSession, path)
