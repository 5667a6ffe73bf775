"""Summaries and gates over metric and report rows.

All are aggregates, so one short row a group is shuffled from each task. Null
counters count as zero; an empty table gives an empty summary, or one row of
zeros where the summary has no group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What must be met, by target.
POLICIES = {"live": (30.0, "fail", "fail"), "paper": (300.0, "fail", "degrade")}
DEGRADING = ("messages_invalid_total", "invalid_timestamp_total", "duplicates_total", "gaps_total", "gap_irreparable_total", "heartbeat_missed_total", "buffer_dropped_total")


def merge_stream_metrics(rows: DataFrame, label: Sequence[str], counters: Sequence[str], largest: Sequence[str]) -> DataFrame:
    """For each stream the sum of its counters and the largest of the others; degraded where a telling counter is above zero."""
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in counters]
    out = rows.groupBy(*label).agg(*sums, *[F.max(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in largest])
    bad = [F.col(c) > 0 for c in counters if c in DEGRADING]
    return out.withColumn("degraded", F.greatest(*bad, F.lit(False), F.lit(False)))


def shadow_summary(reports: DataFrame, max_failed: int = 0, max_critical: int = 0) -> DataFrame:
    """One row over reports (pass_ok, severity): failures by severity, and whether they are few enough."""
    failed = ~F.coalesce(F.col("pass_ok"), F.lit(False))
    by = [F.count_if(failed & (F.col("severity") == s)).alias(f"{s}_failures") for s in ("critical", "high", "medium")]
    out = reports.agg(F.count("*").alias("total_reports"), F.count_if(failed).alias("failed_reports"), *by)
    return out.withColumn("pass_ok", (F.col("failed_reports") <= max_failed) & (F.col("critical_failures") <= max_critical))


def probe_summary(probes: DataFrame, max_failures: int = 0, max_unknown: int = 0, max_seconds: float = 1.0) -> DataFrame:
    """One row over probes (status, seconds): requests by status, the longest, and whether they pass."""
    known = ("ok", "degrade", "fail")
    by = [F.count_if(F.col("status") == s).alias(f"{s}_count") for s in known]
    unknown = F.count_if(~F.coalesce(F.col("status").isin(*known), F.lit(False))).alias("unknown_count")
    out = probes.agg(F.count("*").alias("total_requests"), *by, unknown, F.coalesce(F.max("seconds"), F.lit(0.0)).alias("max_seconds"))
    return out.withColumn("pass_ok", (F.col("fail_count") <= max_failures) & (F.col("unknown_count") <= max_unknown) & (F.col("max_seconds") <= max_seconds))


def gate_reasons(mismatches: Column, stale: Column, slow: Column, invalid: Column, wide: Column, max_mismatches: int = 0) -> Column:
    """Why a release is refused: the names of the limits that its counts break."""
    rules = ((mismatches > max_mismatches, "parity_mismatch"), (stale > 0, "stale_features_detected"), (slow > 0, "latency_slo_breached"), (invalid > 0, "invalid_ratio_breached"), (wide > 0, "feature_cardinality_breached"))
    return F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for rule, name in rules]))


def alerts(observed: Column, threshold: int) -> Column:
    """True at each multiple of the threshold."""
    return F.coalesce((observed > 0) & (observed % threshold == 0), F.lit(False))


def expected_bars(start_us: Column, end_us: Column, interval_us: int) -> Column:
    """How many bars a backfill of the range should give; both ends have one."""
    return F.floor((end_us - start_us) / F.lit(interval_us)) + 1


def dataset_versions(rows: DataFrame, partition: Sequence[str], order: Sequence[str], run: str, seq: str) -> DataFrame:
    """Per partition its rows, the lineage of its first and last row, and a short digest of both: the version."""
    at = F.struct(*order)
    ends = rows.groupBy(*partition).agg(F.count("*").alias("row_count"), F.min_by(F.struct(run, seq), at).alias("first"), F.max_by(F.struct(run, seq), at).alias("last"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*partition, "row_count", f"first.{run}", f"first.{seq}", f"last.{run}", f"last.{seq}")]
    lineage = F.substring(F.sha2(F.concat_ws("|", *parts[: len(partition)], *parts[len(partition) + 1 :]), 256), 1, 16)
    return ends.select(*partition, "row_count", F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16).alias("dataset_version"), lineage.alias("lineage_id"))


def point_in_time_status(found: Column, flags: Column, contract_ok: Column, target: str) -> tuple[Column, Column]:
    """(status, reason) of a point-in-time answer; age does not matter there."""
    _, on_missing, on_invalid = POLICIES["live" if target == "live" else "paper"]
    less = "fail" if on_missing == "fail" else "degrade"
    flagged = F.size(flags) > 0
    status = F.when(~found, less).when(flagged, on_invalid).when(~contract_ok, less).otherwise("ok")
    return status, F.when(~found, "point_in_time_missing").when(flagged, "quality_flags").when(~contract_ok, "contract_validation")
