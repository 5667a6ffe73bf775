"""WARC records in ZIP packages, written and range-read by Spark tasks.

Writing. Payloads with equal digests are stored once: of the records with equal
payloads the one with the largest page_id is the response, the others are
revisits that name it; payloads under ``min_bytes`` are all responses. Which is
which comes from an aggregate over (digest, page_id) alone. A bitmap of fixed
size marks the pages whose payload is not alone; only those are shuffled, by
page_id and digest, so that no digest is one task's work. Each task then writes packages into the shared folder: a ZIP with one
stored member of gzipped WARC records, one a record, and one stored member
that indexes them by offset and length. A package is closed at
``package_bytes``, so none grows with a partition.

Reading. A task opens a package and reads its last bytes, the ZIP64 records
if there are any, and the central directory; from there the local header of
each stored member. Records are then read by byte range as the index says
(or, without an index, one gzip member after another). Nothing is extracted
to disk, and no member is held as a whole.

Paths are handled by pyarrow's file systems, so the shared folder may be a
local mount or an object store. A task that runs again writes the same records
to a path of its own; only the paths that its rows name are read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalbook.llm._shared import new_path, row_slices, stored, with_mark

PACKAGE_BYTES = 128 << 20
GZIP_LEVEL = 5
DATE = "2024-01-01T00:00:00Z"
RECORDS, INDEX = "archive/records.warc.gz", "indexes/records.jsonl"
PREFIX = "urn:page:"
_EOCD, _EOCD64_AT, _EOCD64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record: a response, or a revisit without the payload.

    The HTTP header keeps the full payload's length in both.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    clean = "".join((url or "").splitlines())
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{PREFIX}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", clean)] if clean else []),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        *([("WARC-Refers-To", f"<{PREFIX}{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class PackageWriter:
    """One ZIP package: records are streamed into it, the index follows at the end."""

    def __init__(self, path: str) -> None:
        self.path = path
        system, inside = pa.fs.FileSystem.from_uri(path)
        if isinstance(system, pa.fs.LocalFileSystem):
            system.create_dir(inside.rpartition("/")[0])
        self.out = system.open_output_stream(inside)
        self.zip = zipfile.ZipFile(_Forward(self.out), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(RECORDS, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True)
        self.index: list[tuple[str, int, int]] = []
        self.size = 0

    def add(self, record_id: str, record: bytes) -> None:
        packed = _gzip(record)
        self.member.write(packed)
        self.index.append((record_id, self.size, len(packed)))
        self.size += len(packed)

    def close(self) -> int:
        self.member.close()
        lines = "".join(json.dumps({"id": i, "offset": o, "length": n}) + "\n" for i, o, n in self.index)
        with self.zip.open(zipfile.ZipInfo(INDEX, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True) as member:
            member.write(lines.encode())
        self.zip.close()
        self.out.close()
        return len(self.index)


class _Forward(io.RawIOBase):
    """A stream that only goes forward, as object stores give it."""

    def __init__(self, out: pa.NativeFile) -> None:
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)


def write_packages(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, min_bytes: int = 0) -> DataFrame:
    """Write each row of ``pages`` (page_id, url, html) as a record; (path, records) of the packages.

    Null html is the empty payload; page_id and url may be null. Rows with
    equal page_id and payload are all responses if they have the largest id. The
    result is a written table, as packages must not be written twice.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    large = keyed.where(F.octet_length("payload") >= min_bytes)
    owners = stored(large.groupBy("digest").agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("owned"), "owner"), "payload-owners")
    known = keyed.select("page_id", "digest").distinct().join(owners, F.col("digest") == F.col("owned"))
    known = stored(known.select(F.col("page_id").alias("known_id"), F.col("digest").alias("known_digest"), "owner"), "shared-payloads")
    shared = with_mark(keyed, F.xxhash64("page_id", "digest"), known.select(F.xxhash64("known_id", "known_digest")), "shared")
    joined = shared.where("shared").join(known, F.col("page_id").eqNullSafe(F.col("known_id")) & (F.col("digest") == F.col("known_digest")), "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("owner")), None).otherwise(F.col("owner"))
    alone = shared.where("not shared").select("page_id", "url", "payload", F.lit(None).cast("bigint").alias("refers_to"))
    ready = alone.unionByName(joined.select("page_id", "url", "payload", refers.alias("refers_to")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer: PackageWriter | None = None
        done: list[tuple[str, int]] = []
        for part in row_slices(batches):
            for page_id, url, payload, refers_to in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                if writer is None:
                    writer = PackageWriter(f"{folder}/{uuid.uuid4().hex}.zip")
                writer.add(f"{PREFIX}{'' if page_id is None else page_id}", warc_record(page_id, url, payload, refers_to))
                if writer.size >= package_bytes:
                    done.append((writer.path, writer.close()))
                    writer = None
        if writer is not None:
            done.append((writer.path, writer.close()))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    return stored(ready.mapInArrow(run, "path string, records bigint"), "packages")


@dataclass(frozen=True)
class Member:
    """A stored member: its bytes lie at start, size of them."""

    name: str
    start: int
    size: int


def _at(file: pa.NativeFile, start: int, size: int) -> bytes:
    file.seek(start)
    return file.read(size)


def stored_members(file: pa.NativeFile) -> list[Member]:
    """Members of a ZIP that are stored as they are, from its central directory."""
    size = file.size()
    tail_start = max(0, size - 65_557)  # the longest comment and the record's 22 bytes
    tail = _at(file, tail_start, size - tail_start)
    place = tail.rfind(_EOCD)
    if place < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    entries, length, start = struct.unpack_from("<HII", tail, place + 10)
    if place >= 20 and tail[place - 20 : place - 16] == _EOCD64_AT:
        (at,) = struct.unpack_from("<Q", tail, place - 12)
        record = _at(file, at, 56)
        if record[:4] != _EOCD64:
            raise ValueError("no ZIP64 end of central directory where its locator points")
        entries, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, out = _at(file, start, length), 0, []
    for _ in range(entries):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        method, packed, full, name_size, extra_size, note_size, header = (
            struct.unpack_from("<H", directory, at + 10)[0],
            *struct.unpack_from("<II", directory, at + 20),
            *struct.unpack_from("<HHH", directory, at + 28),
            struct.unpack_from("<I", directory, at + 42)[0],
        )
        name = directory[at + 46 : at + 46 + name_size].decode("utf-8", "replace")
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        packed, header = _zip64(extra, full, packed, header)
        at += 46 + name_size + extra_size + note_size
        if method == 0 and not name.endswith("/"):
            local = _at(file, header, 30)
            if local[:4] != _LOCAL:
                raise ValueError(f"no local header for {name}")
            own_name, own_extra = struct.unpack_from("<HH", local, 26)
            out.append(Member(name, header + 30 + own_name + own_extra, packed))
    return out


def _zip64(extra: bytes, full: int, packed: int, header: int) -> tuple[int, int]:
    """Packed size and header offset, from the ZIP64 field where they stand there."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = list(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            if full == 0xFFFFFFFF:
                values.pop(0)
            if packed == 0xFFFFFFFF:
                packed = values.pop(0)
            if header == 0xFFFFFFFF:
                header = values.pop(0)
        at += 4 + size
    return packed, header


def record_ranges(file: pa.NativeFile) -> Iterator[bytes]:
    """The uncompressed records of a package, each read by its byte range."""
    members = stored_members(file)
    by_name = {m.name: m for m in members}
    for member in members:
        if not member.name.endswith(".warc.gz"):
            continue
        index = by_name.get("indexes/" + member.name.rpartition("/")[2].removesuffix(".warc.gz") + ".jsonl")
        if index:
            for line in _lines(file, index):
                entry = json.loads(line)
                yield zlib.decompress(_at(file, member.start + entry["offset"], entry["length"]), 31)
        else:
            yield from _scan(file, member)


def _lines(file: pa.NativeFile, member: Member, step: int = 1 << 20) -> Iterator[bytes]:
    left = b""
    for start in range(0, member.size, step):
        *whole, left = (left + _at(file, member.start + start, min(step, member.size - start))).split(b"\n")
        yield from whole
    if left:
        yield left


def _scan(file: pa.NativeFile, member: Member, step: int = 1 << 20) -> Iterator[bytes]:
    """Records of a member without an index: one gzip member after another."""
    unpacker, got, at = zlib.decompressobj(31), [], 0
    while at < member.size:
        data = _at(file, member.start + at, min(step, member.size - at))
        at += len(data)
        while data:
            got.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(got)
                unpacker, got = zlib.decompressobj(31), []


def parse_record(raw: bytes) -> dict[str, object]:
    """page_id, url, payload, its full length, digest, record type and what it refers to.

    A response whose payload has another digest than it says is an error.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line[16:]) for line in http.decode("latin-1").split("\r\n") if line.startswith("Content-Length: "))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (digest_of(payload) != digest or len(payload) != length):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page = lambda key: int(v) if (v := fields.get(key, "")[1:-1].removeprefix(PREFIX)) else None
    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


COLUMNS = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
SCHEMA = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """A row for each record of the packages named in the column ``path``.

    payload is null for revisits, and for all without ``payloads``. Each task
    reads one package, however short the rows that name them are.
    """
    tasks = max(1, packages.count())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inside = pa.fs.FileSystem.from_uri(path)
                with system.open_input_file(inside) as file:
                    rows: list[dict[str, object]] = []
                    for raw in record_ranges(file):
                        row = parse_record(raw)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        if len(rows) == 256:
                            yield _batch(rows)
                            rows = []
                    yield _batch(rows)

    return packages.select("path").repartition(tasks).mapInArrow(run, SCHEMA)


def _batch(rows: list[dict[str, object]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in COLUMNS.items()], names=list(COLUMNS))


def archive_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to packages in the shared folder and read every record back."""
    packages = write_packages(pages, new_path(spark, "warc"), min_bytes=min_bytes)
    return read_packages(packages, payloads=False)
