"""Comparisons: parity, shadow partitions, replay sequences, catalog drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.operators.dedup import ordered_unique


def parity(offline: DataFrame, batch: DataFrame, online: DataFrame, keys: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """(keys, name, reason) where three tables (keys, name, value, ord) of feature values disagree.

    The last row by ``ord`` counts for each key and name. Offline values are
    compared with the batch's exactly and with the online ones within the
    tolerance. Values that only the online table has are told as extra_online.
    """
    by = [*keys, "name"]
    last = lambda df, out: df.groupBy(*by).agg(F.max_by(F.struct("value"), "ord").alias(out))
    known = last(offline, "a").join(last(batch, "b"), by, "left").join(last(online, "c"), by, "full_outer")
    a, b, c = F.col("a.value"), F.col("b.value"), F.col("c.value")
    reason = (
        F.when(F.col("a").isNull(), "extra_online")
        .when(F.col("b").isNull(), "missing_batch")
        .when(~a.eqNullSafe(b), "persisted_batch_diverged")
        .when(F.col("c").isNull(), "missing_online")
        .when(a.isNull() != c.isNull(), "missing_value")
        .when(F.abs(a - c) > tolerance, "tolerance_exceeded")
    )
    return known.select(*by, reason.alias("reason")).where("reason is not null")


def canonical_row(*columns: str, floats: Sequence[str] = ()) -> Column:
    """One string for a row: floats with ten decimals, absent values empty."""
    parts = [F.coalesce(F.format_string("%.10f", F.col(c)) if c in floats else F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat_ws("|", *parts)


def snapshot(rows: DataFrame, partition: Sequence[str], identity: Column, row: Column, time_us: str) -> DataFrame:
    """Per partition: rows, distinct identities, order-free checksums, first and last time.

    The checksums add up 64-bit hashes, so no partition's rows are gathered.
    """
    marked = rows.select(*partition, identity.alias("_id"), F.col(time_us).alias("_us"), F.xxhash64(row).alias("_hash"))
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    each = marked.groupBy(*partition, "_id").agg(F.count("*").alias("_n"), wide(F.col("_hash")).alias("_h"), F.min("_us").alias("_a"), F.max("_us").alias("_z"))
    return each.groupBy(*partition).agg(
        F.sum("_n").alias("rows"),
        F.count("*").alias("identities"),
        wide(F.xxhash64("_id")).cast("string").alias("identity_sum"),
        F.sum("_h").cast("string").alias("row_sum"),
        F.min("_a").alias("first_us"),
        F.max("_z").alias("last_us"),
    )


def shadow_compare(primary: DataFrame, shadow: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Snapshots of two pipelines side by side: differences and whether they matter."""
    fields = [c for c in primary.columns if c not in partition]
    p = primary.select(*partition, F.struct(*fields).alias("p"))
    s = shadow.select(*partition, F.struct(*fields).alias("s"))
    both = p.join(s, list(partition), "full_outer")
    gap = lambda f: F.coalesce(F.col(f"s.{f}"), F.lit(0)) - F.coalesce(F.col(f"p.{f}"), F.lit(0))
    same = lambda f: F.col(f"p.{f}").eqNullSafe(F.col(f"s.{f}"))
    return both.select(
        *partition,
        gap("rows").alias("row_diff"),
        gap("identities").alias("identity_diff"),
        same("identity_sum").alias("same_identities"),
        same("row_sum").alias("same_rows"),
        (gap("first_us") if "first_us" in fields else F.lit(0)).alias("first_us_diff"),
        (gap("last_us") if "last_us" in fields else F.lit(0)).alias("last_us_diff"),
        (~(same("row_sum") & same("identity_sum") & same("rows"))).alias("significant"),
    )


def sequence_parity(replayed: DataFrame, stored: DataFrame, key: str, order: str) -> DataFrame:
    """(place, replayed, stored) where the ordered unique keys of two tables differ."""
    a = ordered_unique(replayed, key, order).select(F.col("place"), F.col(key).alias("replayed"))
    b = ordered_unique(stored, key, order).select(F.col("place"), F.col(key).alias("stored"))
    return a.join(b, "place", "full_outer").where(~F.col("replayed").eqNullSafe(F.col("stored")))


def catalog_drift(before: DataFrame, after: DataFrame, keys: Sequence[str], fields: Sequence[str], material: Sequence[str]) -> DataFrame:
    """(keys, change, changed, is_material) for entries added, removed or changed."""
    b = before.select(*keys, F.struct(*fields).alias("b"))
    a = after.select(*keys, F.struct(*fields).alias("a"))
    both = b.join(a, list(keys), "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")), F.lit(f)) for f in fields]))
    change = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.size("changed") > 0, "changed")
    out = both.withColumn("changed", changed).withColumn("change", change).where("change is not null")
    is_material = (F.col("change") != "changed") | F.arrays_overlap("changed", F.array(*map(F.lit, material)))
    return out.select(*keys, "change", F.when(F.col("change") == "changed", F.array_join("changed", ",")).alias("changed"), is_material.alias("is_material"))


def first_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the first feature name (name, value tables) in which two versions differ."""
    by = [*keys, "name"]
    both = left.select(*by, F.struct("value").alias("l")).join(right.select(*by, F.struct("value").alias("r")), by, "full_outer")
    reason = F.when(F.col("l").isNull() | F.col("r").isNull(), "missing:high").when(~F.col("l.value").eqNullSafe(F.col("r.value")), "value:medium")
    return both.withColumn("reason", reason).where("reason is not null").groupBy(*keys).agg(F.min_by("reason", "name").alias("reason"), F.min("name").alias("name"))
