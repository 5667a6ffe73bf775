"""Reading inputs and writing intermediate tables where every executor can see them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_ROWS = 256
BITMAP_BITS = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark so that any file system works."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting gets a temporary folder of this
    machine; on a cluster the setting must be there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses, with the scheme of its file system."""
    base = shared_dir(spark)
    if "://" not in base:
        where = spark._jvm.org.apache.hadoop.fs.Path(base)
        whole = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
        base = whole if "://" in whole else whole.replace("file:/", "file:///", 1)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, each with underscores added until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Short slices of Arrow batches, so that few long texts are decoded at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_mark(rows: DataFrame, key: Column, wanted: DataFrame, mark: str) -> DataFrame:
    """``rows`` with a boolean column: true wherever the hash ``key`` is in the only column of ``wanted``, and seldom elsewhere.

    What is broadcast is a bitmap of BITMAP_BITS bits, whatever the input. A
    fuller one lets more rows through and changes nothing else.
    """
    place = lambda hashed: F.pmod(hashed, F.lit(BITMAP_BITS)) + 1
    bucket, words = fresh(rows, "mark_bucket", "mark_words")
    at = wanted.select(place(F.col(wanted.columns[0])).alias("place"))
    bitmap = at.groupBy(F.bitmap_bucket_number("place").alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    word = lambda i: F.conv(F.hex(F.substring("bits", (i * 8 + 1).cast("int"), F.lit(8))), 16, -10).cast("bigint")
    bitmap = bitmap.select(bucket, F.transform(F.sequence(F.lit(0), F.lit(511)), word).alias(words))
    bit = F.bitmap_bit_position(place(key)).cast("int")
    in_word = (bit % 64).bitwiseXOR(F.lit(56))  # the first of a word's eight bytes is its highest
    found = rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(place(key)) == F.col(bucket), "left")  # BITMAP_BITS / 32768 rows of 4 KB at most
    return found.withColumn(mark, F.coalesce(F.getbit(F.get(F.col(words), F.shiftright(bit, 6)), in_word) == 1, F.lit(False))).drop(bucket, words)


def marked(rows: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """Rows whose hash ``key`` may be in ``wanted``: all that are, and few others."""
    (mark,) = fresh(rows, "may_be_in")
    return with_mark(rows, key, wanted, mark).where(mark).drop(mark)


def forget(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
