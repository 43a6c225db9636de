"""Packages against the standard library's ZIP reader and writer, and the archive's round trip with the awkward rows."""

import base64
import gzip
import hashlib
import io
import zipfile
from collections import Counter, defaultdict

import compare
import pytest

from tarnworks.llm import zip_package, zip_warc
from tarnworks.llm.scratch import Scratch, _open_fs

SCHEMA = "page_id long, url string, html string, row long, key string, same string, size string, members int"


def frame(spark, rows):
    return spark.createDataFrame([(k, u, h, 1, "k", "s", "z", 0) for k, u, h in rows], SCHEMA).repartition(3)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


LONG = "<p>é</p>" * 400_000
ROWS = [
    (5, "http://a/ü?q=1\r\nX: y", "same"), (3, "http://b", "same"), (9, None, "same"), (None, "http://n", "same"), (4, "", None), (6, "u", ""),
    (7, "u", LONG), (8, "u", LONG), (11, "u", "alone"), (12, "u", "twice"), (12, "u", "twice"), (None, None, "nobody's"), (None, None, "nobody's"),
    (-2, "u", "WARC/1.1\r\n\r\nPK\x05\x06"), *((100 + i, "u", "hot") for i in range(300)),
]


@pytest.mark.parametrize("revisit_from", [0, 5])
def test_round_trip(spark, revisit_from):
    got = zip_warc.archive(frame(spark, ROWS), revisit_from=revisit_from).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (k, len((h or "").encode()), digest(h)) for k, _, h in ROWS)
    by_digest = defaultdict(list)
    for r in got:
        by_digest[r.payload_digest].append(r)
    for rows in by_digest.values():
        first = [r for r in rows if r.record_type == "response"]
        if rows[0].payload_bytes < revisit_from:
            assert len(first) == len(rows) and all(r.refers_to is None for r in rows)
            continue
        keys = [r.page_id for r in rows if r.page_id is not None]
        assert [r.page_id for r in first] == [min(keys, default=None)]
        assert all(r.refers_to == min(keys, default=None) for r in rows if r.record_type == "revisit")


def test_matches_sql(spark, sf_dir):
    assert compare.differences(zip_warc.query(spark, sf_dir), compare.connect(sf_dir), zip_warc.ORACLE) == []


def test_empty_table_and_text_keys(spark):
    assert zip_warc.archive(frame(spark, [])).collect() == []
    rows = spark.createDataFrame([("a/b c:key:+%é", "u", "t"), ("", "u", "t"), (None, "u", "t")], "id string, url string, html string")
    got = {(r.id, r.record_type, r.refers_to) for r in zip_warc.archive(rows, key="id").collect()}
    assert got == {("", "response", None), ("a/b c:key:+%é", "revisit", ""), (None, "revisit", "")}


def test_packages_roll_and_other_tools_read_them(spark):
    scratch = Scratch(spark, "t")
    folder = scratch.path("p")
    rows = [(i, f"http://h/{i}", f"<p>{i % 40}</p>") for i in range(100)]
    manifest = zip_warc.write_packages(frame(spark, rows), folder, scratch, most_records=7).collect()
    assert sum(m.records for m in manifest) == 100 and max(m.records for m in manifest) == 7
    fs, root = _open_fs(folder)
    for m in manifest:
        data = fs.open_input_file(f"{root}/{m.package}").readall()
        assert len(data) == m.bytes
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            assert z.testzip() is None and z.namelist() == [zip_warc.ARCHIVE, zip_warc.INDEX]
            assert gzip.decompress(z.read(zip_warc.ARCHIVE)).count(b"WARC/1.1\r\nWARC-Type") == m.records
    packages = spark.createDataFrame(manifest)
    for run_bytes in (1, 500, 1 << 20):  # a record a run, some, all
        found = zip_warc.read_packages(packages, folder, payloads=True, run_bytes=run_bytes).collect()
        bodies = {r.record_id: r.payload for r in found if r.record_type == "response"}
        assert len(found) == 100 and len(bodies) == 40
        assert all(r.refers_to in bodies and r.payload is None for r in found if r.record_type == "revisit")
        assert {r.target_uri for r in found} == {u for _, u, _ in rows}


def foreign(entries, zip64=False, comment=b""):
    """A package by the standard library; zip64 writes its members with 64-bit fields."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = comment
        for name, data in entries:
            with z.open(name, "w", force_zip64=zip64) as member:
                member.write(data)
    return out.getvalue()


def reader(data):
    return (lambda at, n: data[at : at + n]), len(data)


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("comment", [b"", b"note PK\x05\x06 within" + b"x" * 40, b"c" * 65_535])
def test_directories_of_other_writers(zip64, comment):
    entries = [("archive/é.warc.gz", b"abc" * 50), ("empty", b""), ("indexes/index.cdxj", b"{}\n")]
    data = foreign(entries, zip64, comment)
    read, length = reader(data)
    found = zip_package.members(read, length)
    assert [m.name for m in found] == [name for name, _ in entries]
    for member, (_, body) in zip(found, entries):
        assert read(zip_package.place_of(read, member), member.size) == body


def test_many_members_need_the_64_bit_directory():
    data = foreign([(f"m{i}", b"%d" % i) for i in range(65_600)])
    read, length = reader(data)
    found = zip_package.members(read, length)
    assert len(found) == 65_600 and read(zip_package.place_of(read, found[-1]), 5) == b"65599"


def test_own_writer_against_own_reader_and_zipfile():
    out = io.BytesIO()
    writer = zip_package.PackageWriter(out.write)
    for name in ("a", "b/ü"):
        writer.open(name)
        assert writer.write(b"first") == 0 and writer.write(b"second") == 5
        writer.close_member()
    writer.finish()
    data = out.getvalue()
    read, length = reader(data)
    assert [(m.name, m.size, read(zip_package.place_of(read, m), m.size)) for m in zip_package.members(read, length)] == [
        ("a", 11, b"firstsecond"), ("b/ü", 11, b"firstsecond")]
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and z.read("b/ü") == b"firstsecond"


def test_broken_packages_are_refused():
    data = foreign([("archive/x.warc.gz", b"abc")])
    for bad in (b"", b"PK", data[:-5], b"\x00" * 5000):
        with pytest.raises(zip_package.BrokenPackage):
            zip_package.members(*reader(bad))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/x.warc.gz", b"abc" * 100)
    read, length = reader(out.getvalue())
    with pytest.raises(zip_package.BrokenPackage, match="stored"):
        zip_package.place_of(read, zip_package.members(read, length)[0])


def test_foreign_package_with_several_archives(spark, folder):
    """Archives and an index that names them, written elsewhere."""
    def record(text, name):
        body = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + text
        return gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <" + name + b">\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n")

    a, b, c = record(b"one", b"urn:1"), record(b"two", b"urn:2"), record(b"three", b"urn:3")
    index = "".join(f'com,x)/ 2020 {{"offset": "{o}", "length": "{n}", "filename": "{f}"}}\n' for o, n, f in (
        (len(a), len(b), "p.warc.gz"), (0, len(a), "p.warc.gz"), (0, len(c), "q.warc.gz")))
    place = folder("foreign")
    fs, root = _open_fs(place)
    fs.create_dir(root)
    with fs.open_output_stream(f"{root}/f.wacz") as out:
        out.write(foreign([("archive/p.warc.gz", a + b), ("archive/q.warc.gz", c), ("indexes/i.cdxj", index.encode())], zip64=True))
    got = zip_warc.read_packages(spark.createDataFrame([("f.wacz",)], "package string"), place, payloads=True).collect()
    assert {(r.record_id, bytes(r.payload)) for r in got} == {("<urn:1>", b"one"), ("<urn:2>", b"two"), ("<urn:3>", b"three")}


def test_changed_payload_is_noticed():
    row = {"row": 1, "key": "1", "url": "u", "size": 4, "sha1": hashlib.sha1(b"text").hexdigest(), "first_row": None, "first_key": None, "payload": b"tent"}
    fields, block = zip_warc.parse_record(zip_warc._record(row, "2025-01-01T00:00:00Z")[0])
    with pytest.raises(ValueError, match="isn't the one"):
        zip_warc._digested(fields, block)
