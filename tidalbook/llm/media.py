"""Media columns: payloads kept as content-defined chunks, each chunk once.

A text's UTF-8 bytes are padded with bytes 255 to a positive multiple of
``UNIT`` and stored as an 8-bit greyscale image in PGM form, UNIT samples wide.
The image is cut where a rolling gear hash of the last 32 bytes has its top
bits zero, so equal passages give equal chunks wherever they stand.

Storing
-------
1. Chunk digests are counted; those that occur more than once are shared.
2. The shared digests are marked in a bitmap of fixed size (BITMAP_BITS), which
   is broadcast. A chunk whose bit is not set occurs once and is kept in its
   own row; one whose bit is set goes to the chunk table, where an aggregate by
   digest keeps one copy. A fuller bitmap sends more chunks that way, and loses
   nothing.
3. The media table has a row for each payload: the ordered digests and sizes of
   its chunks, which of them it holds itself, and their bytes.

Reading back joins the digests that a row lacks with the chunk table, puts the
chunks in order, and verifies each chunk's digest and the image's own.

Most bytes are written once and never shuffled: only shared chunks, and rows
that need them, move. A chunk that very many rows share is one row of the chunk
table; adaptive execution splits the join's hot key.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import row_slices, stored

UNIT = 576
MIN_CHUNK, CUT_BITS, MAX_CHUNK = 512, 11, 8192
BITMAP_BITS = 1 << 26
DIGEST_BYTES = 20

#: One 32-bit number for each byte value, from its SHA-256.
GEAR = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)], dtype=np.uint32)


def payload_of(text: str | None) -> tuple[bytes, int]:
    """(padded payload, bytes before padding)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, -(-len(raw) // UNIT)) * UNIT
    return raw.ljust(size, b"\xff"), len(raw)


def to_image(payload: bytes) -> bytes:
    return b"P5\n%d %d\n255\n" % (UNIT, len(payload) // UNIT) + payload


def from_image(image: bytes) -> np.ndarray:
    """Samples (rows, columns) of a PGM image of 8-bit samples."""
    kind, size, depth, samples = image.split(b"\n", 3)
    width, height = map(int, size.split())
    if kind != b"P5" or depth != b"255" or len(samples) != width * height:
        raise ValueError("not an 8-bit PGM image")
    return np.frombuffer(samples, dtype=np.uint8).reshape(height, width)


def cut(data: bytes) -> list[bytes]:
    """Content-defined chunks of MIN_CHUNK to MAX_CHUNK bytes; the last may be shorter."""
    rolling = GEAR[np.frombuffer(data, dtype=np.uint8)]
    for shift in (1, 2, 4, 8, 16):  # each step doubles the bytes that a hash covers
        if len(rolling) > shift:
            rolling[shift:] += rolling[:-shift] << np.uint32(shift)
    places = (np.flatnonzero(rolling >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    out, start = [], 0
    while start < len(data):
        at = bisect_left(places, start + MIN_CHUNK)
        end = min(places[at] if at < len(places) else len(data), start + MAX_CHUNK, len(data))
        out.append(data[start:end])
        start = end
    return out


def chunk_digest(chunk: bytes) -> bytes:
    return hashlib.sha1(chunk).digest()


def bit_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little") % BITMAP_BITS


def describe(samples: np.ndarray) -> str:
    """Statistics of the samples: equal samples give equal strings."""
    counts = np.bincount(samples.ravel(), minlength=256)
    share = counts[counts > 0] / samples.size
    values = np.arange(256)
    total = int((counts * values).sum())
    square = int((counts * values * values).sum())
    mean = total / samples.size
    spread = max(square / samples.size - mean * mean, 0.0) ** 0.5
    return f"rows={samples.shape[0]};mean={mean:.4f};std={spread:.4f};entropy={float(-(share * np.log2(share)).sum()):.4f};values={len(share)}"


def _bitmap(docs: DataFrame) -> np.ndarray:
    """Bytes of the bitmap of digests that occur more than once, BITMAP_BITS bits whatever the corpus."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            bits = [1 + bit_of(chunk_digest(c)) for t in part.column(0).to_pylist() for c in cut(to_image(payload_of(t)[0]))]
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.int64())], names=["bit"])

    shared = docs.select("text").mapInArrow(run, "bit bigint").groupBy("bit").agg(F.count("*").alias("n")).where("n > 1")
    pieces = shared.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for row in pieces.collect():  # BITMAP_BITS / 32768 rows of 4 KB at most
        data = np.frombuffer(bytes(row.bits), dtype=np.uint8)  # bucket 1 has the numbers from 1 to 32768
        out[(row.bucket - 1) * 4096 : (row.bucket - 1) * 4096 + len(data)] = data
    return out


def store_media(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(media table, chunk table) for the rows of ``docs`` (doc_id, text), both written."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shared = spark.sparkContext.broadcast(_bitmap(texts))

    def chunks_of(text: str | None) -> tuple[bytes, int, list[tuple[bytes, bytes, bool]]]:
        bits = shared.value
        payload, n_bytes = payload_of(text)
        image = to_image(payload)
        found = []
        for chunk in cut(image):
            digest = chunk_digest(chunk)
            bit = bit_of(digest)
            found.append((digest, chunk, not bits[bit // 8] >> bit % 8 & 1))
        return image, n_bytes, found

    def media(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            rows = [chunks_of(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([n for _, n, _ in rows], pa.int64()),
                    pa.array([hashlib.sha256(image).hexdigest() for image, _, _ in rows], pa.string()),
                    pa.array([[d for d, _, _ in f] for _, _, f in rows], pa.list_(pa.binary())),
                    pa.array([[len(c) for _, c, _ in f] for _, _, f in rows], pa.list_(pa.int32())),
                    pa.array([[own for _, _, own in f] for _, _, f in rows], pa.list_(pa.bool_())),
                    pa.array([b"".join(c for _, c, own in f if own) for _, _, f in rows], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "media_sha256", "digests", "sizes", "own", "bytes"],
            )

    def shared_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            found = {d: c for t in part.column(0).to_pylist() for d, c, own in chunks_of(t)[2] if not own}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["digest", "chunk"])

    table = texts.mapInArrow(media, "doc_id bigint, n_bytes bigint, media_sha256 string, digests array<binary>, sizes array<int>, own array<boolean>, bytes binary")
    table = stored(table.withColumn("row", F.monotonically_increasing_id()), "media")
    pool = texts.select("text").mapInArrow(shared_chunks, "digest binary, chunk binary").groupBy("digest").agg(F.first("chunk").alias("chunk"))
    return table, stored(pool, "chunks")


def read_media(table: DataFrame, pool: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media_sha256, image): the images put together again and verified."""
    lacking = F.exists("own", lambda own: ~own)
    needs = (
        table.where(lacking)
        .select("row", F.posexplode(F.arrays_zip("digests", "own")).alias("place", "ref"))
        .where("not ref.own")
        .select("row", "place", F.col("ref.digests").alias("wanted"))
    )
    brought = (
        needs.join(pool, needs.wanted == pool.digest)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("place", "chunk"))).alias("brought"))  # one payload's own chunks
        .select(F.col("row").alias("brought_row"), F.transform("brought", lambda b: b["chunk"]).alias("brought"))
    )
    columns = ["doc_id", "n_bytes", "media_sha256", "digests", "sizes", "own", "bytes", "brought"]
    part = table.where(lacking).join(brought, F.col("row") == F.col("brought_row")).select(columns)
    whole = table.where(~lacking).withColumn("brought", F.array().cast("array<binary>")).select(columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            images = []
            for expected, digests, sizes, own, held, brought in zip(*(part.column(k).to_pylist() for k in range(2, 8)), strict=True):
                chunks, at, others = [], 0, iter(brought)
                for digest, size, mine in zip(digests, sizes, own, strict=True):
                    chunk = held[at : at + size] if mine else next(others)
                    at += size * mine
                    if len(chunk) != size or chunk_digest(chunk) != digest:
                        raise ValueError("a chunk is not what its digest says")
                    chunks.append(chunk)
                images.append(b"".join(chunks))
                if hashlib.sha256(images[-1]).hexdigest() != expected:
                    raise ValueError("an image is not what was stored")
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(images, pa.binary())], names=["doc_id", "n_bytes", "media_sha256", "image"])

    return whole.unionByName(part).mapInArrow(run, "doc_id bigint, n_bytes bigint, media_sha256 string, image binary")


def media_features(docs: DataFrame) -> DataFrame:
    """Store the texts of ``docs`` as media, read them back and describe them.

    One row per row of ``docs``: doc_id, n_bytes, payload_bytes, payload_sha256,
    tail_crc32, media_bytes, media_sha256, feature. All but n_bytes come from
    what was read back. Null texts count as empty, whose payload is one unit of
    padding. doc_id may be null; repeated rows each keep a row.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            images = part.column(2).to_pylist()
            samples = [from_image(image) for image in images]
            payloads = [s.tobytes() for s in samples]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(p) for p in payloads], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                    pa.array([zlib.crc32(p[-32:]) for p in payloads], pa.int64()),
                    pa.array([len(i) for i in images], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in images], pa.string()),
                    pa.array([describe(s) for s in samples], pa.string()),
                ],
                names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    schema = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return read_media(*store_media(docs)).select("doc_id", "n_bytes", "image").mapInArrow(run, schema)
