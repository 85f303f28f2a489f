"""WARC records inside ZIP packages: written by tasks, read back by byte ranges without unpacking anything.

A package is a ZIP file whose members are *stored*, not compressed: ``archive/data.warc.gz`` (every record a gzip member of
its own) and ``indexes/index.cdx`` (a line per record with offset and length).  So a record is a byte range of the package:

1. ``members``: a package's last bytes give the end of its central directory, behind a ZIP64 record where the package
   needs one; the directory gives the members; each member's local header gives where its bytes begin.
2. ``record_ranges``: the index members are read line by line, neighbouring records become ranges of about ``RANGE`` bytes.
   A package without index gives its data members as ranges.
3. ``read_records``: ranges are dealt out over the tasks, which read and parse just these bytes.  A package of any size
   is thus read by many tasks, which hold a record and a step of the range at a time.

Packages lie in the folder all executors share, or wherever ``pyarrow.fs`` reaches.  A task names a package anew on every
attempt and reports it when it is closed; what a lost attempt left is never read.

*Repeated payloads.*  Of records with equal payloads of ``least`` bytes or more the one with the smallest page id is a
response, the others are revisits: HTTP headers without payload, and the response they refer to.  Shorter payloads
are always responses.

Defined results: a null payload is empty, a null address an empty header; control characters and blanks in an
address are percent-encoded; rows that share the smallest page id are responses all, a row without id is a revisit if
another row with its payload has one (else a response); repeated rows give a record each; an empty table gives no package and no
rows; other columns are not read.  Members that are compressed or encrypted are listed and not read.  A file that is
no ZIP package is listed with its fault; ``read_records`` raises it, or leaves the package out with ``skip_damaged``.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import parked, scratch

#: Bytes of records after which a task opens the next package, bytes of one range, bytes of one read.
PACKAGE, RANGE, STEP = 64 << 20, 4 << 20, 1 << 20
LEAST = 100
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"


# ---------------------------------------------------------------- files


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, with the scheme of its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch(spark)}/{name}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def located(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- ZIP directories


@dataclass
class Member:
    """A member of a package; ``offset`` is its local header, ``method`` 0 if stored."""

    name: str
    method: int
    flags: int
    size: int
    offset: int

    @property
    def readable(self) -> bool:
        return self.method == 0 and not self.flags & 1


class NoPackage(ValueError):
    """The file has no ZIP directory that fits it."""


def _at(file, offset: int, size: int) -> bytes:
    if offset < 0:
        raise NoPackage("an offset before the file")
    file.seek(offset)
    return file.read(size)


def directory_place(file, size: int) -> tuple[int, int, int, int]:
    """(offset, bytes, entries) of the central directory, and the bytes that were put in front of the package."""
    tail = _at(file, start := max(0, size - 22 - 0xFFFF), size)
    at = len(tail)
    while (at := tail.rfind(b"PK\x05\x06", 0, at)) >= 0:
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    else:
        raise NoPackage("no end of a central directory")
    here, count, length, offset = start + at, *struct.unpack_from("<HII", tail, at + 10)
    end = here
    locator = _at(file, here - 20, 20) if here >= 20 else b""
    if locator[:4] == b"PK\x06\x07":
        # the record lies where the locator says, or right before it if something was put in front of the package
        for end in (struct.unpack_from("<Q", locator, 8)[0], here - 20 - 56):
            record = _at(file, end, 56) if 0 <= end <= here - 76 else b""
            if record[:4] == b"PK\x06\x06":
                count, length, offset = struct.unpack_from("<QQQ", record, 32)
                break
        else:
            raise NoPackage("no ZIP64 record where its locator points")
    if end - length < offset:
        raise NoPackage("a directory longer than the file")
    return end - length, length, count, end - length - offset


def directory(file, size: int) -> Iterator[Member]:
    """The members, entry by entry; the directory is read in steps."""
    begin, length, count, shift = directory_place(file, size)
    held, at, stop = b"", begin, begin + length
    for _ in range(count):
        while len(held) < 46 or len(held) < 46 + sum(struct.unpack_from("<HHH", held, 28)):
            if at >= stop:
                raise NoPackage("a directory of fewer entries than stated")
            more = _at(file, at, min(STEP, stop - at))
            if not more:
                raise NoPackage("a directory that ends early")
            held, at = held + more, at + len(more)
        if held[:4] != b"PK\x01\x02":
            raise NoPackage("a directory entry without its mark")
        flags, method = struct.unpack_from("<HH", held, 8)
        packed, raw, n, m, k = struct.unpack_from("<IIHHH", held, 20)
        offset = struct.unpack_from("<I", held, 42)[0]
        name, extra = held[46 : 46 + n], held[46 + n : 46 + n + m]
        held = held[46 + n + m + k :]
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<HH", extra)
            if kind == 1:  # the fields that are full above, in this order
                wide = list(struct.unpack_from(f"<{min(width, 24) // 8}Q", extra, 4))
                raw = wide.pop(0) if raw == 0xFFFFFFFF and wide else raw
                packed = wide.pop(0) if packed == 0xFFFFFFFF and wide else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF and wide else offset
            extra = extra[4 + width :]
        yield Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, flags, packed, offset + shift)


def data_start(file, member: Member) -> int:
    """Where the bytes of a member begin: its local header has lengths of its own."""
    head = _at(file, member.offset, 30)
    if head[:4] != b"PK\x03\x04":
        raise NoPackage(f"no local header of {member.name}")
    return member.offset + 30 + sum(struct.unpack_from("<HH", head, 26))


# ---------------------------------------------------------------- records


def header(lines: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def clean_address(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def record(page: int | None, url: str, payload: bytes, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit has the HTTP headers of its payload and not the payload."""
    http = header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))], "HTTP/1.1 200 OK")
    block = http if refers_to is not None else http + payload
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        lines += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    return header(lines, "WARC/1.1") + block + b"\r\n\r\n"


def _fields(raw: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in raw.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def unpacked(file, start: int, length: int) -> Iterator[bytes]:
    """The bytes of a range in steps; without their compression, if the range begins with a gzip member."""
    at, raw, unpack, packed = start, b"", None, None
    while True:
        if not raw:
            raw = _at(file, at, min(STEP, start + length - at))
            at += len(raw)
            if not raw:
                break
        packed = raw[:2] == b"\x1f\x8b" if packed is None else packed
        if packed:
            unpack = unpack or zlib.decompressobj(31)
            yield unpack.decompress(raw)
            unpack, raw = (None, unpack.unused_data) if unpack.eof else (unpack, b"")
        else:
            yield raw
            raw = b""
    if at < start + length or unpack:
        raise NoPackage("a range that ends early")


def parsed(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records in some bytes, which come in pieces; one record is held at a time."""
    held, needed = bytearray(), 0
    for piece in pieces:
        held += piece
        while len(held) >= needed:
            skip = len(held) - len(held.lstrip(b"\r\n"))
            end = held.find(b"\r\n\r\n", skip) + 4
            if end < 4:
                break
            named = _fields(bytes(held[skip:end]))
            needed = end + int(named["content-length"])
            if len(held) < needed:
                break
            yield named, bytes(held[end:needed])
            del held[:needed]
            needed = 0
    if held.strip(b"\r\n"):
        raise NoPackage("a record that ends early")


def row_of(named: dict[str, str], block: bytes) -> tuple:
    """(page_id, url, payload, bytes, digest, type, refers_to, intact) of a response or revisit."""
    kind, stated = named["warc-type"], named.get("warc-payload-digest", "").removeprefix("sha256:")
    split = block.find(b"\r\n\r\n") + 4
    if kind == "revisit":  # the payload is the response's, of which the headers tell
        size = int(_fields(block[:split]).get("content-length", 0))
        payload, digest = None, stated
    else:
        payload = block[split:]
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    refers = _page(named.get("warc-refers-to"))
    return _page(named.get("warc-record-id")), named.get("warc-target-uri"), payload, size, digest, kind, refers, digest == stated


# ---------------------------------------------------------------- writing


class _Package:
    """A package being written: the data member first, as records come, then its index."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        files, place = located(self.path)
        files.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index, self.at, self.records = io.BytesIO(), 0, 0

    def add(self, raw: bytes, url: str, digest: str) -> None:
        pack = zlib.compressobj(4, zlib.DEFLATED, 31)
        packed = pack.compress(raw) + pack.flush()
        self.data.write(packed)
        line = {"url": url, "digest": f"sha256:{digest}", "offset": self.at, "length": len(packed), "filename": DATA.split("/")[1]}
        self.index.write(f"{url} {json.dumps(line)}\n".encode())
        self.at, self.records = self.at + len(packed), self.records + 1

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            member.write(self.index.getbuffer())
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return self.path, size, self.records


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, size, digest, refers_to): refers_to is the response's page for revisits, else null."""
    rows = pages.withColumn("size", F.length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "payload", "size", "digest", refers.alias("refers_to"))


def write_packages(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row into packages in ``folder``; gives their (path, bytes, records)."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")
    )
    limit = PACKAGE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page, address, payload, size, digest, refers in zip(*batch.columns, strict=True):
                package = package or _Package(folder)
                address, digest, size, refers = clean_address(address.as_py()), digest.as_py(), size.as_py(), refers.as_py()
                raw = record(page.as_py(), address, payload.as_py(), size, digest, refers, date)
                package.add(raw, address, digest)
                if package.at >= limit:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True) if done else [[]] * 3, [pa.string(), pa.int64(), pa.int64()], strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["path", "bytes", "records"])

    return parked(with_revisits(rows, least).mapInArrow(run, "path string, bytes long, records long"), "packages")


# ---------------------------------------------------------------- reading


def _each(paths: DataFrame, of_file, schema: str) -> DataFrame:
    """Rows that ``of_file(file, size, path)`` yields for every path."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, place = located(path)
                with files.open_input_file(place) as file:
                    held = []
                    for row in of_file(file, file.size(), path):
                        held.append(dict(zip(names, row, strict=True)))
                        if len(held) == 8192:
                            yield from pa.Table.from_pylist(held, kinds).to_batches()
                            held = []
                    if held:
                        yield from pa.Table.from_pylist(held, kinds).to_batches()

    kinds = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]]) for c in schema.split(", ")])
    return paths.select("path").mapInArrow(run, schema)


def members(paths: DataFrame) -> DataFrame:
    """(path, name, start, size, readable, problem): where the bytes of every member lie, from the directories alone."""

    def listed(file, size: int, path: str) -> Iterator[tuple]:
        try:
            for m in directory(file, size):
                yield path, m.name, data_start(file, m) if m.readable else None, m.size, m.readable, None
        except NoPackage as fault:
            yield path, None, None, None, False, str(fault)

    return _each(paths, listed, "path string, name string, start long, size long, readable boolean, problem string")


def _lines(file, start: int, size: int) -> Iterator[bytes]:
    held, at = b"", start
    while at < start + size:
        more = _at(file, at, min(STEP, start + size - at))
        if not more:
            raise NoPackage("an index that ends early")
        at += len(more)
        *whole, held = (held + more).split(b"\n")
        yield from whole
    yield held


def record_ranges(paths: DataFrame, skip_damaged: bool = False) -> DataFrame:
    """(path, start, length): byte ranges that hold whole records of the packages."""

    def ranges(file, size: int, path: str) -> Iterator[tuple]:
        try:
            found = [(m, data_start(file, m)) for m in directory(file, size) if m.readable and m.name.startswith(("archive/", "indexes/"))]
        except NoPackage:
            if skip_damaged:
                return
            raise
        data = {m.name.removeprefix("archive/"): (start, m.size) for m, start in found if m.name.startswith("archive/")}
        indexes = [(start, m.size) for m, start in found if m.name.startswith("indexes/") and m.name.endswith((".cdx", ".cdxj"))]
        if not indexes:
            yield from ((path, start, size) for start, size in data.values() if size)
        for start, size in indexes:
            open_range = None
            for line in _lines(file, start, size):
                if b"{" not in line:
                    continue
                entry = json.loads(line[line.index(b"{") :])
                at, length = data[entry["filename"]][0] + int(entry["offset"]), int(entry["length"])
                if open_range and at == sum(open_range) and open_range[1] < RANGE:
                    open_range = open_range[0], open_range[1] + length
                else:
                    if open_range:
                        yield path, *open_range
                    open_range = at, length
            if open_range:
                yield path, *open_range

    return _each(paths, ranges, "path string, start long, length long")


RECORD = [
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_()),
]


def read_records(paths: DataFrame, payload: bool = True, skip_damaged: bool = False) -> DataFrame:
    """A row per response or revisit of the packages at ``path``.

    ``payload_bytes`` and ``payload_digest`` are of the bytes read (of a revisit: as its headers state them), ``intact`` tells
    whether the digest is the stated one.  Without ``payload`` the payloads stay in the tasks.
    """
    spread = max(1, int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = record_ranges(paths, skip_damaged).repartition(spread, "path", "start")
    kinds = [(n, k) for n, k in RECORD if payload or n != "payload"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = dict(zip([n for n, _ in RECORD], zip(*rows, strict=True), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[n], k) for n, k in kinds], [n for n, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, place = located(path)
                with files.open_input_file(place) as file:
                    rows, size = [], 0
                    for named, block in parsed(unpacked(file, start, length)):
                        if named.get("warc-type") in ("response", "revisit"):
                            rows.append(row_of(named, block))
                            size += len(block)
                        if size >= RANGE:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ranges.mapInArrow(run, ", ".join(f"{n} {names[k]}" for n, k in kinds))
