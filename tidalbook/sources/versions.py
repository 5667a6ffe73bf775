"""Reading behind a version gate, and over the layout of before.

Each Parquet file tells the version of its schema in its footer: by the keys
``schema_version`` and ``normalizer_version``, or by column metadata of these
names, which is how ``stamped`` makes Spark write them. A file that tells none,
or one that is not known, is an error that names it: rows of a meaning that
nobody knows are not read. The gate is one aggregate over footers that tasks
read; one row comes to the driver, whatever the number of files.

Files of v2 and v3 may lack columns that came later (``ADDED``); these are null,
but for ``normalizer_version``, which is what the footer says or ``DEFAULT``.
Where files differ in that, rows are joined with the footers by file. Files of
v1 get no such columns filled. Null values of a column that a file has stay.

Layouts: ``<base>/<dataset>/env=/venue=/symbol=/date=`` and, before it,
``<base>/<env>/symbol=/date=``. ``read_layouts`` takes the older one only where
the newer one has nothing: for a whole env, or partition by partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalbook.functions.normalize import VERSION as DEFAULT
from tidalbook.operators.scan import fresh
from tidalbook.sources import files

# Known versions, and the columns that v2 and v3 have gained.
KNOWN = ("v1", "v2", "v3")
ADDED = {"normalizer_version": "string", "provider_ts": "timestamp", "historical_feed_kind": "string", "raw_run_id": "string", "raw_ingestion_seq": "bigint"}
#: Partition columns that are texts, whatever they look like.
TEXTS = ("env", "venue", "symbol")
LEGACY_VENUE = "BINANCE"


class VersionError(ValueError):
    """A file without a known schema version."""


def stamped(rows: DataFrame, version: str, normalizer_version: str | None = None) -> DataFrame:
    """The same rows, written with their versions in the footers of all files."""
    told = {"schema_version": version} | ({"normalizer_version": normalizer_version} if normalizer_version else {})
    return rows.select(*[F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, **told}) for f in rows.schema.fields])


def _reason() -> Column:
    unknown = F.concat(F.lit("unsupported schema_version: "), F.col("version"))
    return F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("version").isNull(), "schema_version missing").when(~F.col("version").isin(*KNOWN), unknown)


def refused(footers: DataFrame) -> DataFrame:
    """(file, reason): files that the gate does not let through."""
    return footers.select("file", _reason().alias("reason")).where("reason is not null")


def _lacking() -> tuple[Column, Column]:
    lacks = (F.col("version") != "v1") & ~F.array_contains("columns", "normalizer_version")
    return lacks, F.coalesce("normalizer_version", F.lit(DEFAULT))


def _typed(spark: SparkSession, path: str, base: str | None) -> DataFrame:
    reader = lambda: spark.read.options(**({"basePath": base} if base else {}))
    found = reader().option("mergeSchema", "true").parquet(path).schema
    return reader().schema(T.StructType([T.StructField(f.name, T.StringType() if f.name in TEXTS else f.dataType) for f in found.fields])).parquet(path)


def read_gated(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """All rows of a file or folder of known versions, with the columns of ADDED; VersionError names the first file that is refused.

    Folders below ``base`` (the path itself, if not given) are partition columns.
    """
    found = files.footers(spark, path)
    lacks, fill = _lacking()
    reason = _reason()
    seen = found.agg(
        F.count("*").alias("files"),
        F.count(reason).alias("refused"),
        F.min(F.when(reason.isNotNull(), F.struct(F.col("file"), reason.alias("reason")))).alias("first"),
        F.count_if(F.col("version") == "v1").alias("old"),
        F.count_if(lacks).alias("lacking"),
        F.min(F.when(lacks, fill)).alias("low"),
        F.max(F.when(lacks, fill)).alias("high"),
    ).first()
    if seen.refused:
        raise VersionError(f"{seen["first"].reason} in {seen["first"].file}" + (f" and {seen.refused - 1} other files" if seen.refused > 1 else ""))
    rows = _typed(spark, path, base)
    if seen.files == seen.old:
        return rows
    absent = {c: F.lit(None).cast(t) for c, t in ADDED.items() if c not in rows.columns}
    if not seen.lacking:
        return rows.withColumns(absent)
    if seen.lacking == seen.files and seen.low == seen.high:
        return rows.withColumns(absent | {"normalizer_version": F.lit(seen.low)})
    file, of_file, filled = fresh([*rows.columns, *ADDED], "in_file", "of_file", "filled_version")
    names = [f"`{c}`" for c in rows.columns]
    placed = rows.select(*names, F.col("_metadata.file_path").alias(file)).withColumns(absent)
    fills = found.where(lacks).select(F.col("file").alias(of_file), fill.alias(filled))
    out = placed.join(fills, F.col(file) == F.col(of_file), "left").withColumn("normalizer_version", F.coalesce(filled, "normalizer_version"))
    return out.drop(file, of_file, filled)


def read_layouts(spark: SparkSession, base: str, dataset: str, env: str, by_partition: bool = False) -> DataFrame:
    """Rows of an env by the layout of now, and of the one before where there are none.

    With ``by_partition`` each symbol and date is looked at by itself; otherwise
    the older layout is read only if the newer one has no file of the env at all.
    FileNotFoundError where neither has any.
    """
    now, before = f"{base.rstrip('/')}/{dataset}", f"{base.rstrip('/')}/{env}"
    kept = f"{now}/env={env}"
    has_now, has_before = files.exists(spark, kept), files.exists(spark, before)
    if not has_now and not has_before:
        raise FileNotFoundError(f"neither {kept} nor {before}")
    new = read_gated(spark, kept, now) if has_now else None
    if not has_before or (has_now and not by_partition):
        return new
    old = read_gated(spark, before).withColumns({"env": F.lit(env), "venue": F.lit(LEGACY_VENUE)})
    if new is None:
        return old
    taken_symbol, taken_date = fresh(old.columns, "taken_symbol", "taken_date")
    taken = new.select(F.col("symbol").alias(taken_symbol), F.col("date").alias(taken_date)).distinct()
    rest = old.join(taken, F.col("symbol").eqNullSafe(F.col(taken_symbol)) & F.col("date").eqNullSafe(F.col(taken_date)), "left_anti")
    return new.unionByName(rest, allowMissingColumns=True)
