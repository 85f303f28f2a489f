"""ZIP packages of WARC records: round trip, directories against the standard library, ZIP64, damaged and odd input."""

import gzip
import hashlib
import io
import os
import struct
import zipfile

import pytest

from lapforge.llm import op12, queries

FOLDER = "/root/testdata/sf0.01"


def plain(pages, least=100):
    """{row: (page_id, bytes, digest, type, refers_to)} by the definition."""
    first = {}
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= least and i is not None:
            first[raw] = min(i, first.get(raw, i))
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        to = first.get(raw)
        to = None if to == i else to
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def paths(spark, *names):
    return spark.createDataFrame([(str(n),) for n in names], "path string")


def test_query_against_definition(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows(queries.op12_zip_warc(spark, FOLDER)) == plain(pages)


PAGES = [
    (5, "http://a/1", "x" * 100), (3, "http://a/2", "x" * 100), (3, "http://a/2", "x" * 100), (9, "http://b/ü ä\r\nX: y", "é" * 50), (8, None, "é" * 50),
    (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", "x" * 100), (None, "n", "n" * 200), (None, "n", "n" * 200),
    (7, "long", "line\r\n\r\nWARC/1.1\r\n" * 200_000), (11, "y", "y" * 99), (10, "y", "y" * 99), (-2, "neg", "z" * 101), (12, "neg", "z" * 101), (13, "nul", "\0\r\n\r\n\x1f\x8b" * 30),
]


@pytest.mark.parametrize("limit", [op12.PACKAGE, 300])
def test_round_trip(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(op12, "PACKAGE", limit)
    monkeypatch.setattr(op12, "RANGE", 500)
    df = spark.createDataFrame([(*p, 1, "q") for p in PAGES], "page_id long, url string, html string, size int, digest string")
    packages = op12.write_packages(df, f"file:{tmp_path}")
    assert sum(r.records for r in packages.collect()) == len(PAGES)
    assert all(os.path.getsize(r.path[5:]) == r.bytes for r in packages.collect())
    found = op12.read_records(packages)
    assert rows(found) == plain(PAGES)
    got = {r.page_id: r for r in found.collect()}
    assert all(r.intact for r in got.values()) and got[7].payload.decode() == PAGES[12][2] and got[13].payload.decode() == PAGES[17][2]
    assert got[9].url == "http://b/ü%20ä%0D%0AX:%20y" and got[8].url == "" and got[9].payload is None
    for r in packages.collect():  # the standard library reads the same members, and every record stands alone
        with zipfile.ZipFile(r.path[5:]) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {0}
            assert gzip.decompress(z.read(op12.DATA)).startswith(b"WARC/1.1\r\n")
    assert "payload" not in op12.read_records(packages, payload=False).columns


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    packages = op12.write_packages(df, str(tmp_path / "none"))
    assert packages.count() == 0 and op12.read_records(packages).count() == 0


def listed(raw, wide=False):
    return [(m.name, m.method, m.size, m.offset) for m in op12.directory(io.BytesIO(raw), len(raw))]


def written(force, comment=b"", n=3):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(n):
            info = zipfile.ZipInfo(f"archive/ü{i}.warc")
            info.compress_type = i % 2 * 8
            with z.open(info, "w", force_zip64=force) as f:
                f.write(b"PK\x05\x06 bytes " * (i * 30))
        z.comment = comment
    return out.getvalue()


def as_zip64(raw):
    """The same package with a ZIP64 end record, all sizes and offsets of its directory moved to ZIP64 fields."""
    end = raw.rindex(b"PK\x05\x06")
    count, length, offset = struct.unpack_from("<HII", raw, end + 10)
    entries, at = b"", offset
    for _ in range(count):
        packed, full, n, m, k = struct.unpack_from("<IIHHH", raw, at + 20)
        place = struct.unpack_from("<I", raw, at + 42)[0]
        extra = struct.pack("<HHH", 0x7777, 2, 1) + struct.pack("<HHQQQ", 1, 24, full, packed, place)
        entries += raw[at : at + 20] + struct.pack("<IIHHH", 0xFFFFFFFF, 0xFFFFFFFF, n, len(extra), k) + raw[at + 34 : at + 42]
        entries += struct.pack("<I", 0xFFFFFFFF) + raw[at + 46 : at + 46 + n] + extra + raw[at + 46 + n + m : at + 46 + n + m + k]
        at += 46 + n + m + k
    record = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, count, count, len(entries), offset)
    locator = struct.pack("<IIQI", 0x07064B50, 0, offset + len(entries), 1)
    return raw[:offset] + entries + record + locator + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)


@pytest.mark.parametrize("force", [False, True])
@pytest.mark.parametrize("comment", [b"", b"a comment" + b"." * 3000])
@pytest.mark.parametrize("front", [b"", b"#!/bin/sh\n" * 9])
@pytest.mark.parametrize("wide", [False, True])
def test_directories(force, comment, front, wide):
    raw = written(force, b"" if wide else comment)
    raw = front + (as_zip64(raw) if wide else raw)
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        want = [(i.filename, i.compress_type, i.compress_size, i.header_offset) for i in z.infolist()]
        assert listed(raw) == want
        for m in op12.directory(io.BytesIO(raw), len(raw)):
            start = op12.data_start(io.BytesIO(raw), m)
            if m.readable:
                assert raw[start : start + m.size] == z.read(m.name)


def test_mark_inside_a_comment():
    assert listed(written(False, b"PK\x05\x06 is the mark" + b"." * 300)) == listed(written(False))


def test_many_members(monkeypatch):
    """More than 65 535 members need ZIP64, and the directory is read in steps."""
    monkeypatch.setattr(op12, "STEP", 1000)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(66_000):
            z.writestr(zipfile.ZipInfo(f"m{i}"), b"")
    assert [m[0] for m in listed(out.getvalue())] == [f"m{i}" for i in range(66_000)]


def warc(pages):
    return [op12.record(i, u, h.encode(), len(h), hashlib.sha256(h.encode()).hexdigest(), None, "2020-01-01T00:00:00Z") for i, u, h in pages]


@pytest.mark.parametrize("packed", [True, False])
def test_packages_of_others(spark, tmp_path, monkeypatch, packed):
    """No index, plain or one gzip member over all records, other record types, compressed members beside."""
    monkeypatch.setattr(op12, "STEP", 7)
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(1, "a", "one"), (2, "b", "x" * 3000), (3, "c", "")]
    raw = info + b"".join(warc(pages))
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("archive/a.warc.gz", gzip.compress(raw) if packed else raw)
        z.writestr("archive/b.warc", raw, compress_type=zipfile.ZIP_DEFLATED)
    where = paths(spark, tmp_path / "p.zip")
    assert rows(op12.read_records(where)) == plain(pages)
    assert [r.readable for r in op12.members(where).orderBy("name").collect()] == [True, False]


def test_damaged_files(spark, tmp_path):
    raw = written(False)
    for name, content in {"empty": b"", "text": b"no package" * 99, "cut": raw[:-30], "head": raw[:200] + b"\0" * 90 + raw[290:]}.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "good").write_bytes(written(False, n=1))
    where = paths(spark, *[tmp_path / n for n in ("empty", "text", "cut", "good")])
    found = {os.path.basename(r.path): r.problem for r in op12.members(where).collect()}
    assert found["good"] is None and all(found[n] for n in ("empty", "text", "cut"))
    assert op12.read_records(where, skip_damaged=True).count() == 0
    with pytest.raises(Exception, match="no end of a central directory"):
        op12.read_records(where).count()


def test_cut_record():
    raw = b"".join(warc([(1, "a", "one" * 99)]))
    with pytest.raises(op12.NoPackage):
        list(op12.parsed(iter([raw[:-40]])))
    with pytest.raises(op12.NoPackage):
        list(op12.unpacked(io.BytesIO(gzip.compress(raw)[:-9]), 0, len(gzip.compress(raw)) - 9))
