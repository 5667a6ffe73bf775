"""What is asked of files as such: lists, Parquet footers and digests, each file in the task that it falls to.

Spark's readers give rows; a footer's version or the digest of the bytes they do
not give. Here tasks open the files themselves, by their URI, through the file
systems that Arrow knows (local, HDFS, S3, GCS), and read a footer alone or the
bytes in blocks, so a file of any size takes the memory of one block.

Files are told by the URI that ``_metadata.file_path`` has for their rows, so
that what is found here joins to rows. A folder without files gives an empty
table; a file that cannot be read as Parquet has a null version and the reason
in ``error``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 4 << 20
FOOTERS = "file string, version string, normalizer_version string, columns array<string>, row_count bigint, error string"
DIGESTS = "file string, sha256 string, bytes bigint, lines bigint"
#: Where Spark keeps the schema of what it wrote, with the metadata of columns.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def listed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(file, bytes) of all files below a path that hold a byte; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))


def opened(uri: str) -> pa.NativeFile:
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:/") :].lstrip("/")
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _stamps(told: dict[bytes, bytes]) -> dict[str, str]:
    """Versions that a footer tells, by keys of its own or by the metadata of a column that Spark wrote."""
    out: dict[str, str] = {}
    for one in json.loads(told.get(SPARK_SCHEMA, b"{}")).get("fields", ()):
        out = {**{k: str(v) for k, v in one.get("metadata", {}).items()}, **out}
    return {**out, **{k.decode(): v.decode("utf-8", "replace") for k, v in told.items() if k in (b"schema_version", b"normalizer_version")}}


def _footer(uri: str) -> dict[str, object]:
    try:
        with opened(uri) as file:
            found = pq.read_metadata(file)
    except (pa.ArrowInvalid, OSError) as broken:
        return {"file": uri, "error": f"unreadable: {broken}"[:300]}
    said = _stamps(found.metadata or {})
    return {"file": uri, "version": said.get("schema_version"), "normalizer_version": said.get("normalizer_version"), "columns": found.schema.to_arrow_schema().names, "row_count": found.num_rows}


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("version", pa.string()), ("normalizer_version", pa.string()), ("columns", pa.list_(pa.string())), ("row_count", pa.int64()), ("error", pa.string())])
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_footer(uri) for uri in batch.column(0).to_pylist()], schema=schema)


def footers(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Per Parquet file its versions, columns and rows, from the footer alone."""
    return listed(spark, path, glob).select("file").mapInArrow(_footers, FOOTERS)


def _digest(uri: str) -> dict[str, object]:
    digest, size, lines = hashlib.sha256(), 0, 0
    with opened(uri) as file:
        while block := file.read(BLOCK):
            digest.update(block)
            size, lines = size + len(block), lines + block.count(b"\n")
    return {"file": uri, "sha256": digest.hexdigest(), "bytes": size, "lines": lines}


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("sha256", pa.string()), ("bytes", pa.int64()), ("lines", pa.int64())])
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_pylist([_digest(uri)], schema=schema)


def digests(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Per file the digest of its bytes, their number and that of its line ends, read in blocks."""
    return listed(spark, path, glob).select("file").mapInArrow(_digests, DIGESTS)
