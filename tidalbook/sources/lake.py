"""The partitioned lake: layout, writes, reads, compaction, health, queries, raw landing.

Layout: ``<base>/<dataset>/env=/venue=/symbol=/date=``, written with
``partitionBy`` so that Spark prunes by path. All paths go through Spark's file
systems.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalbook.operators.dedup import keep_first
from tidalbook.operators.scan import fresh
from tidalbook.sources.files import digests

PARTITIONS = ("env", "venue", "symbol", "date")
#: Order of rows in a file.
FILE_ORDER = ("event_us", "arrival_seq", "symbol", "source")
#: Hash buckets that a partition's rows may be spread over, for partitions of very many rows.
SPREAD = 8


def with_partitions(events: DataFrame, env: str, venue: str = "BINANCE") -> DataFrame:
    """Add env, venue (capitals) and date (the day of the event)."""
    return events.withColumns({"env": F.lit(env), "venue": F.upper(F.lit(venue)), "date": F.to_date("event_ts")})


def write_segments(events: DataFrame, path: str, spread: int = SPREAD) -> None:
    """Append events as sorted segments. A hot partition is spread over several tasks and files."""
    salt = F.pmod(F.xxhash64("arrival_seq"), F.lit(spread))
    dealt = events.repartition(*[F.col(p) for p in PARTITIONS], salt)
    dealt.sortWithinPartitions(*PARTITIONS, *[c for c in FILE_ORDER if c in events.columns and c not in PARTITIONS]).write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def read_segments(spark: SparkSession, path: str, schema: T.StructType | None = None, dedup_key: Sequence[str] = ()) -> DataFrame:
    """All rows of a dataset; with ``dedup_key`` the first of each key by arrival."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path)
    return keep_first(rows, list(dedup_key), ["arrival_seq"]) if dedup_key else rows


def partitions(spark: SparkSession, path: str) -> DataFrame:
    """(env, venue, symbol, date): the partitions that hold rows, from file paths and row counts alone."""
    return spark.read.parquet(path).select(*PARTITIONS).distinct()


def health(spark: SparkSession, path: str, now_us: int) -> DataFrame:
    """Per partition: segments, bytes, and the age in seconds of the oldest segment."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length", "modificationTime")
    part = F.regexp_extract("path", r"((?:env|venue)=.*)/[^/]*$", 1)
    age = (F.lit(now_us) - F.unix_micros(F.min("modificationTime"))) / 1e6
    return files.groupBy(part.alias("partition")).agg(F.count("*").alias("segments"), F.sum("length").alias("bytes"), age.alias("oldest_seconds"))


def health_totals(per_partition: DataFrame) -> DataFrame:
    return per_partition.agg(F.sum("segments").alias("segments"), F.sum("bytes").alias("bytes"), F.max("oldest_seconds").alias("oldest_seconds"))


def compaction_candidates(per_partition: DataFrame, min_segments: int = 2, min_age: float = 300.0, limit: int | None = None) -> DataFrame:
    """Partitions with many or old segments, oldest first, then most segments."""
    out = per_partition.where((F.col("segments") >= min_segments) | (F.col("oldest_seconds") >= min_age)).orderBy(F.desc("oldest_seconds"), F.desc("segments"), "partition")
    return out if limit is None else out.limit(limit)


def compact(spark: SparkSession, path: str, target: str, only: Column | None = None, dedup_key: Sequence[str] = (), files: int = 1) -> None:
    """Rewrite partitions (all, or those that ``only`` picks) into few sorted files at ``target``."""
    rows = read_segments(spark, path, dedup_key=dedup_key)
    rows = rows if only is None else rows.where(only)
    salt = F.pmod(F.xxhash64("arrival_seq"), F.lit(files))
    dealt = rows.repartition(*[F.col(p) for p in PARTITIONS], salt).sortWithinPartitions(*PARTITIONS, *[c for c in FILE_ORDER if c in rows.columns and c not in PARTITIONS])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(target)


def compact_in_place(spark: SparkSession, path: str, only: Column | None = None, dedup_key: Sequence[str] = (), files: int = 1) -> None:
    """Replace the segments of partitions by few sorted files.

    The rows are first written whole to a new folder beside the dataset, and
    what is replaced is the partitions that this folder holds, no others. Spark
    replaces partition by partition, so a reader may meet one that is being
    replaced and rows written meanwhile into it are lost: where others read or
    write at the same time, use ``snapshots.SnapshotTable``. A run that ends
    early leaves the folder, which holds all rows of its partitions.
    """
    staged = f"{path.rstrip('/')}.compacting-{uuid.uuid4().hex}"
    compact(spark, path, staged, only, dedup_key, files)
    rows = spark.read.schema(spark.read.parquet(path).schema).parquet(staged)
    ordered = rows.sortWithinPartitions(*PARTITIONS, *[c for c in FILE_ORDER if c in rows.columns and c not in PARTITIONS])
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(staged)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def query(rows: DataFrame, symbol: str | None = None, venue: str | None = None, start_us: int | None = None, end_us: int | None = None, time: str = "event_us", limit: int | None = None) -> DataFrame:
    """Historical rows: equal symbol and venue, time in the range with both ends; rows without a time pass."""
    out = rows
    for column, value in (("symbol", symbol), ("venue", venue)):
        if value is not None:
            out = out.where(F.col(column) == value)
    inside = F.lit(True)
    if start_us is not None:
        inside = inside & (F.col(time) >= start_us)
    if end_us is not None:
        inside = inside & (F.col(time) <= end_us)
    out = out.where(F.col(time).isNull() | inside)
    return out if limit is None else out.orderBy(time, "arrival_seq").limit(limit)


def curated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each key the newest row (ties: the later arrival) and how many there are."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct("event_us", "arrival_seq"))
    return rows.groupBy(*keys).agg(best.alias("_row"), F.count("*").alias("row_count")).select(*keys, "_row.*", "row_count")


def write_raw(records: DataFrame, path: str) -> None:
    """Land raw messages as JSON lines."""
    records.write.mode("append").json(path)


RAW_SCHEMA = "payload string, venue string, stream_type string, symbol string, exchange_ts timestamp, receive_ts timestamp, run_id string, ingestion_seq bigint"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, line_no, partition columns): the lines of text files with where they stand, from 1.

    A large file is read by several tasks. Each split of a file numbers its
    lines by itself; the splits of a file (some rows a gigabyte) are summed up
    in order, and what comes before a split is joined back to its lines.
    """
    lines = spark.read.text(path)
    columns = [f"`{c}`" for c in lines.columns]
    file, split, read, of_file, of_split, first, before, n = fresh([*lines.columns, "file", "line_no"], "in_file", "in_split", "read_at", "of_file", "of_split", "first_read", "lines_before", "n_lines")
    rows = lines.select(*columns, F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(split)).withColumn(read, F.monotonically_increasing_id())
    splits = rows.groupBy(F.col(file).alias(of_file), F.col(split).alias(of_split)).agg(F.min(read).alias(first), F.count("*").alias(n))
    earlier = Window.partitionBy(of_file).orderBy(of_split).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0)))
    placed = rows.join(splits, (F.col(file) == F.col(of_file)) & (F.col(split) == F.col(of_split)))
    return placed.select(*columns, F.col(file).alias("file"), (F.col(read) - F.col(first) + F.col(before) + 1).alias("line_no"))


def read_raw(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines) of landed JSON lines, each with its file and line_no; blank lines are neither. Partition columns in the path stay."""
    (broken,) = fresh(T.StructType.fromDDL(RAW_SCHEMA).names, "broken")
    schema = T.StructType.fromDDL(RAW_SCHEMA).add(broken, T.StringType())
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    rows = lines.withColumn("row", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}))
    whole = F.col(f"row.{broken}").isNull() & F.col("row").isNotNull()
    extra = [c for c in lines.columns if c != "value" and c not in schema.names]
    return rows.where(whole).select("row.*", *extra).drop(broken), rows.where(~whole).select(F.col("value").alias("_broken"), "file", "line_no")


def replay_key(columns: Sequence[str]) -> list[Column]:
    """Replay order: rows with run and sequence first, by them; then by receive time, file and line, or by the payload where those are not known."""
    numbered = F.col("run_id").isNotNull() & F.col("ingestion_seq").isNotNull()
    ends = [F.col(c) for c in ("file", "line_no") if c in columns] or [F.col("payload")]
    return [F.when(numbered, 0).otherwise(1), F.when(numbered, F.col("run_id")), F.when(numbered, F.col("ingestion_seq")), F.col("receive_ts"), *ends]


def replay_order(raw: DataFrame) -> DataFrame:
    """Rows in replay order."""
    return raw.orderBy(*replay_key(raw.columns))


def ambiguous_order(raw: DataFrame) -> DataFrame:
    """Rows with only one of run and sequence: their replay order is not sure."""
    return raw.where(F.col("run_id").isNull() != F.col("ingestion_seq").isNull())


def replay_report(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count("*").alias("rows"), F.min("exchange_ts").alias("first"), F.max("exchange_ts").alias("last"))


def raw_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per landed file: digest, bytes and line ends; good and broken lines, run ids sorted, first and last exchange time in file order.

    Bytes are digested in blocks and lines are read by splits, so files may be
    larger than a task's memory. Blank lines count as line ends alone; empty run
    ids and null times are left out. Files without a byte have no row.
    """
    good, broken = read_raw(spark, path)
    of_good = good.groupBy("file").agg(
        F.count("*").alias("line_count"),
        F.array_sort(F.collect_set(F.nullif("run_id", F.lit("")))).alias("run_ids"),
        F.min_by("exchange_ts", F.when(F.col("exchange_ts").isNotNull(), F.col("line_no"))).alias("first_exchange_ts"),
        F.max_by("exchange_ts", F.when(F.col("exchange_ts").isNotNull(), F.col("line_no"))).alias("last_exchange_ts"),
    )
    of_broken = broken.groupBy("file").agg(F.count("*").alias("broken_lines"))
    out = digests(spark, path, "*.json").join(of_good, "file", "left").join(of_broken, "file", "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("line_count", "broken_lines")}
    return out.withColumns({**counts, "run_ids": F.coalesce("run_ids", F.array().cast("array<string>")), "file": F.url_decode(F.replace(F.element_at(F.split("file", "/"), -1), F.lit("+"), F.lit("%2B")))})


def handoff(bootstrap: DataFrame, live: DataFrame, key: str, start_us: int, end_us: int, checkpoint: DataFrame | None = None) -> DataFrame:
    """Bootstrap rows of the window, then live rows whose identity is neither there nor in the checkpoint."""
    window = bootstrap.where(F.col("event_us").between(start_us, end_us))
    known = window.select(key)
    if checkpoint is not None:
        known = known.unionByName(checkpoint.select(key))
    fresh = live.join(known.distinct(), key, "left_anti")
    return window.withColumn("phase", F.lit("bootstrap")).unionByName(fresh.withColumn("phase", F.lit("live")))


def route_errors(rejected: DataFrame) -> dict[str, DataFrame]:
    """Rejected rows by where they go: schema drift, quarantine, and the rest."""
    drift = F.coalesce(F.col("reason") == "schema_drift", F.lit(False))
    held = F.col("quarantine_path").isNotNull() & ~drift
    return {"schema_drift": rejected.where(drift), "quarantine": rejected.where(held), "default": rejected.where(~drift & ~held)}
