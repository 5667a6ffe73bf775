"""Materialization runs: which vectors a run wrote, and what it was made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalbook.sources.feature_store import upserted


def record(vectors: DataFrame, run_id: str, definition_hash: str, fingerprint: str, status: str = "completed") -> DataFrame:
    """One row that describes the run of these vectors; an empty run has zero rows and no times."""
    bundle = F.substring(F.sha2(F.lit(f"{definition_hash}|{fingerprint}|{run_id}"), 256), 1, 32)
    return vectors.agg(F.count("*").alias("row_count"), F.min("event_us").alias("min_event_us"), F.max("event_us").alias("max_event_us")).select(
        F.lit(run_id).alias("run_id"), F.lit(definition_hash).alias("definition_hash"), F.lit(fingerprint).alias("input_fingerprint"), bundle.alias("bundle_id"), F.lit(status).alias("status"), "row_count", "min_event_us", "max_event_us"
    )


def record_each(vectors: DataFrame, definition_hash: str, fingerprint: str, status: str = "completed") -> DataFrame:
    """A row for each run_id that the vectors name, all in one aggregate; vectors without a run belong to none."""
    bundle = F.substring(F.sha2(F.concat(F.lit(f"{definition_hash}|{fingerprint}|"), F.col("run_id")), 256), 1, 32)
    rows = vectors.where(F.col("run_id").isNotNull()).groupBy("run_id").agg(F.count("*").alias("row_count"), F.min("event_us").alias("min_event_us"), F.max("event_us").alias("max_event_us"))
    return rows.select(
        "run_id", F.lit(definition_hash).alias("definition_hash"), F.lit(fingerprint).alias("input_fingerprint"), bundle.alias("bundle_id"), F.lit(status).alias("status"), "row_count", "min_event_us", "max_event_us"
    )


def registered(existing: DataFrame | None, new: DataFrame, order: str) -> DataFrame:
    """The registry after new run rows; of one run the last by ``order`` stays."""
    return upserted(existing, new, ["run_id"], order)


def reconstruct(vectors: DataFrame, run_id: str, symbol: str | None = None, scope: str | None = None, start_us: int | None = None, end_us: int | None = None) -> DataFrame:
    """The vectors of a run in order of symbol, event and available time; a scope goes before a symbol, ends are included."""
    out = vectors.where(F.col("run_id") == run_id)
    if scope is not None:
        out = out.where(F.col("entity_scope") == scope)
    elif symbol is not None:
        out = out.where(F.col("symbol") == symbol.strip().upper())
    if start_us is not None:
        out = out.where(F.col("event_us") >= start_us)
    if end_us is not None:
        out = out.where(F.col("event_us") <= end_us)
    return out.orderBy("symbol", "event_us", "available_us")
