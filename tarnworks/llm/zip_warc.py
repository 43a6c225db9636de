"""Web archives in ZIP packages: records written by tasks, found through directories and indexes, read by ranges.

A package holds ``archive/data.warc.gz``, one gzip member a record, and ``indexes/index.cdxj``, one line a record with
its place. Both are stored, so a record is a range of the package: a reader parses the central directory (32 bits
or ZIP64), reads the index, deals runs of records over tasks, and each task reads its ranges. Nothing is extracted.

Of records with equal payloads of at least ``revisit_from`` bytes, that with the smallest key is the response and the others
are revisits, which carry headers, digest and the response's id but no payload. Equal means equal SHA-256 digests.

Defined cases: NULL payloads are empty and NULL addresses too; NULL keys come last when the smallest is chosen, and refer as NULL; of
rows with equal payload and key one, the first by staged row number, is the response; repeated rows are records of their
own; characters that a header line can't hold are percent-encoded; an empty table writes no package and gives an empty result; other
columns are not read. A digest or checksum that doesn't fit raises on reading.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm import zip_package
from tarnworks.llm.scratch import Scratch, _open_fs, read_table
from tarnworks.llm.spread_join import spread_join

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_FROM = 0
PACKAGE_BYTES = 1 << 29
PACKAGE_RECORDS = 100_000
RUN_BYTES = 8 << 20
_OUT_ROWS = 4096
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_UNSAFE = re.compile(r"[^\x21-\x7e]+")
_MANIFEST = "package string, records bigint, bytes bigint"
_RUNS = "package string, place bigint, member bigint, lengths array<bigint>"


# ---- writing ------------------------------------------------------------------------


def record_id(row: int, key: str | None) -> str:
    return f"<urn:row:{row}>" if key is None else f"<urn:row:{row}:key:{quote(key, safe='')}>"


def key_of(identifier: str | None) -> str | None:
    """The key that ``record_id`` put in."""
    _, found, key = (identifier or "").strip("<>").partition(":key:")
    return unquote(key) if found else None


def _record(row: dict, date: str) -> tuple[bytes, dict]:
    """A record, gzipped by itself, and what the index says of it."""
    name = record_id(row["row"], row["key"])
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    fields = [("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if row["url"]:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: quote(m.group()), row["url"])))
    block = _HTTP.format(row["size"]).encode()
    kind = "response"
    if row["first_row"] is not None and row["first_row"] != row["row"]:
        kind = "revisit"
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(row["first_row"], row["first_key"]))]
    else:
        block += row["payload"]
    fields = [("WARC-Type", kind), *fields, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{n}: {v}\r\n" for n, v in fields)
    data = f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress(data) + packed.flush(), {"id": name, "type": kind, "digest": f"sha1:{digest}"}


class _Package:
    """A package that grows in the shared folder; only index lines stay in memory."""

    def __init__(self, folder: str):
        self.fs, root = _open_fs(folder)
        self.fs.create_dir(root, recursive=True)
        self.name = f"{uuid.uuid4().hex}.wacz"  # an attempt's own; only those that Spark commits are named anywhere
        self.path = f"{root}/{self.name}"
        self.out = self.fs.open_output_stream(self.path)
        self.zip = zip_package.PackageWriter(self.out.write)
        self.zip.open(ARCHIVE)
        self.lines: list[bytes] = []

    def add(self, row: dict, date: str) -> None:
        data, entry = _record(row, date)
        place = self.zip.write(data)
        self.lines.append(json.dumps({**entry, "offset": place, "length": len(data)}).encode() + b"\n")

    def full(self, most_bytes: int, most_records: int) -> bool:
        return self.zip.written >= most_bytes or len(self.lines) >= most_records

    def finish(self) -> pa.RecordBatch:
        self.zip.close_member()
        self.zip.open(INDEX)
        for line in self.lines:
            self.zip.write(line)
        self.zip.close_member()
        self.zip.finish()
        self.out.close()
        return pa.RecordBatch.from_pydict({"package": [self.name], "records": [len(self.lines)], "bytes": [self.zip.written]})

    def drop(self) -> None:
        self.out.close()
        self.fs.delete_file(self.path)


def write_packages(df: DataFrame, folder: str, scratch: Scratch, key: str = "page_id", url: str = "url", payload: str = "html",
                   revisit_from: int = REVISIT_FROM, most_bytes: int = PACKAGE_BYTES, most_records: int = PACKAGE_RECORDS,
                   date: datetime | None = None) -> DataFrame:
    """Write every row as a record; returns the manifest (package, records, bytes), staged."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = scratch.stage(
        df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(url).alias("url"), body.alias("payload"))
        .withColumns({"same": F.sha2("payload", 256), "sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("bigint")}), "rows",
    )
    first = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("row")))
    repeated = scratch.stage(
        rows.where(F.col("size") >= revisit_from).groupBy("same").agg(F.count("*").alias("members"), first.alias("first"))
        .where("members > 1"), "repeated",
    )
    known = spread_join(rows, repeated, "same", "members", "row", "left")
    again = F.col("first.row").isNotNull() & (F.col("first.row") != F.col("row"))
    ready = known.select(
        "row", F.col("key").cast("string").alias("key"), F.col("url").cast("string").alias("url"), "size", "sha1",
        F.col("first.row").alias("first_row"), F.col("first.key").cast("string").alias("first_key"),
        F.when(~F.coalesce(again, F.lit(False)), F.col("payload")).alias("payload"),
    )
    moment = (date or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        try:
            for batch in batches:
                for at in range(batch.num_rows):
                    package = package or _Package(folder)
                    package.add({name: batch.column(name)[at].as_py() for name in batch.schema.names}, moment)
                    if package.full(most_bytes, most_records):
                        yield package.finish()
                        package = None
            if package:
                done, package = package, None
                yield done.finish()
        except BaseException:
            if package:
                package.drop()
            raise

    manifest = scratch.stage(ready.mapInArrow(write, _MANIFEST), "manifest")
    scratch.drop("rows", "repeated")
    return manifest


# ---- reading ------------------------------------------------------------------------


def _ranges(folder: str, name: str) -> tuple[Callable[[int, int], bytes], int]:
    fs, root = _open_fs(folder)
    file = fs.open_input_file(f"{root}/{name}")
    length = file.size()

    def read(offset: int, n: int) -> bytes:
        if offset < 0 or offset + n > length:
            raise zip_package.BrokenPackage(f"{name} ends at {length}, not {offset + n}")
        return file.read_at(n, offset)

    return read, length


def _archives(found: list[zip_package.Member]) -> dict[str, zip_package.Member]:
    return {m.name: m for m in found if m.name.startswith("archive/") and m.name.endswith(".warc.gz")}


def _index_runs(folder: str, package: str, run_bytes: int) -> Iterator[tuple[int, int, list[int]]]:
    """(place in the package, place in the archive, lengths of the records) of neighbouring records of a few megabytes."""
    read, length = _ranges(folder, package)
    found = zip_package.members(read, length)
    archives = _archives(found)
    for index in (m for m in found if m.name.startswith("indexes/")):
        start = zip_package.place_of(read, index)
        text = read(start, index.size)
        if zlib.crc32(text) != index.crc:
            raise zip_package.BrokenPackage(f"{index.name} of {package} is damaged")
        entries = [json.loads(line[line.index(b"{"):]) for line in text.splitlines() if b"{" in line]
        by_archive: dict[str, list[tuple[int, int]]] = {}
        for entry in entries:
            by_archive.setdefault(entry.get("filename", ARCHIVE), []).append((int(entry["offset"]), int(entry["length"])))
        for name, places in by_archive.items():
            archive = archives.get(name) or archives.get(f"archive/{name}")
            if archive is None:
                raise zip_package.BrokenPackage(f"{package} has an index of {name}, which isn't there")
            base = zip_package.place_of(read, archive)
            places.sort()
            if places and sum(places[-1]) > archive.size:
                raise zip_package.BrokenPackage(f"the index of {package} goes beyond {name}")
            run: list[int] = []
            start = 0
            for offset, n in places:
                if run and (offset != start + sum(run) or sum(run) + n > run_bytes):
                    yield base + start, start, run
                    run = []
                if not run:
                    start = offset
                run.append(n)
            if run:
                yield base + start, start, run


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of one gzipped record."""
    plain = zlib.decompress(data, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0]!r}")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError(f"the record {fields.get('warc-record-id')} ends early")
    return fields, rest[:length]


def _digested(fields: dict[str, str], block: bytes) -> tuple[int, str, bytes | None]:
    """Bytes, digest and payload; a revisit says in its headers what its response's payload was."""
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields["warc-type"] == "revisit":
        lengths = re.findall(rb"(?im)^content-length:\s*(\d+)", head)
        return int(lengths[0]), stated, None
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if stated and stated != digest:
        raise ValueError(f"the payload of {fields.get('warc-record-id')} isn't the one that was written")
    return len(payload), digest, payload


def read_packages(packages: DataFrame, folder: str, payloads: bool = False, run_bytes: int = RUN_BYTES) -> DataFrame:
    """A row for each record of the packages named in ``packages`` (column package): package, offset in its archive,
    record_id, record_type, target_uri, payload_bytes, payload_digest, refers_to and, with ``payloads``, payload."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("package").to_pylist():
                for place, member, lengths in _index_runs(folder, name, run_bytes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([place], pa.int64()), pa.array([member], pa.int64()), pa.array([lengths], pa.list_(pa.int64()))],
                        ["package", "place", "member", "lengths"],
                    )

    columns = ["package", "offset", "record_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    schema = "package string, offset bigint, record_id string, record_type string, target_uri string, payload_bytes bigint, payload_digest string, refers_to string"
    if payloads:
        columns, kinds, schema = [*columns, "payload"], [*kinds, pa.binary()], f"{schema}, payload binary"
    out = pa.schema(list(zip(columns, kinds)))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, read = None, None
        for batch in batches:
            for run in batch.to_pylist():
                if run["package"] != name:
                    name = run["package"]
                    read, _ = _ranges(folder, name)
                data, at, rows = read(run["place"], sum(run["lengths"])), 0, []
                for n in run["lengths"]:
                    fields, block = parse_record(data[at : at + n])
                    size, digest, payload = _digested(fields, block)
                    rows.append((name, run["member"] + at, fields.get("warc-record-id"), fields["warc-type"], fields.get("warc-target-uri"),
                                 size, digest, fields.get("warc-refers-to"), payload)[: len(columns)])
                    at += n
                    if len(rows) == _OUT_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=out)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=out)

    parts = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = packages.select("package").repartition(parts, "package").mapInArrow(locate, _RUNS)
    return runs.repartition(parts, "package", "place").mapInArrow(fetch, schema)


def records(packages: DataFrame, folder: str, key: str, kind: str) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to), with keys as they were before they were written."""
    def back(identifier: str):
        held = F.regexp_extract(identifier, r":key:([^>]*)>?$", 1)
        return F.when(F.instr(identifier, ":key:") > 0, F.url_decode(F.replace(held, F.lit("+"), F.lit("%2B")))).cast(kind)

    return read_packages(packages, folder).select(
        back("record_id").alias(key), "payload_bytes", "payload_digest", "record_type", back("refers_to").alias("refers_to"),
    )


def archive(df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write the rows as packages in the shared folder, and read the packages back."""
    scratch = Scratch(df.sparkSession, "warc")
    folder = scratch.path("packages")
    manifest = write_packages(df, folder, scratch, key, url, payload, revisit_from)
    return records(manifest, folder, key, df.schema[key].dataType.simpleString())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(read_table(spark, sf_dir, "pages"))


ORACLE = """
WITH b AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, body, min(page_id) OVER (PARTITION BY body) AS least, sha1(body) AS hex FROM b),
bits AS (SELECT *, list_transform(range(40), lambda i: CAST(instr('0123456789abcdef', hex[i + 1]) - 1 AS BIGINT)) AS digits FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(
           -- five bits from bit 5 i on, out of the eight in the two hexadecimal digits that hold them
           ((digits[(5 * i) // 4 + 1] * 16 + coalesce(digits[(5 * i) // 4 + 2], 0)) >> (3 - (5 * i) % 4)) & 31 AS INT)]), '')
           AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to
FROM bits
"""
