"""Replay of landed raw messages: window, order, typed events with lineage, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalbook.functions import normalize
from tidalbook.sources import lake


def window(raw: DataFrame, start: Column | str | None = None, end: Column | str | None = None, **facets: Sequence[str] | None) -> DataFrame:
    """Raw rows of the wanted venues, streams or symbols whose exchange time lies in the range, both ends included.

    A facet is a column with its wanted values; None wants all. Rows without an
    exchange time are in no range. Filters on partition columns prune paths.
    """
    out = raw
    for name, wanted in facets.items():
        if wanted is not None:
            out = out.where(F.col(name).isin(list(wanted)))
    if start is not None:
        out = out.where(F.col("exchange_ts") >= F.lit(start).cast("timestamp"))
    return out if end is None else out.where(F.col("exchange_ts") <= F.lit(end).cast("timestamp"))


def read_window(spark: SparkSession, path: str, start: Column | str | None = None, end: Column | str | None = None, **facets: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """(rows of the window, broken lines) of landed JSON lines; blank lines are neither."""
    good, broken = lake.read_raw(spark, path)
    return window(good, start, end, **facets), broken


KINDS = {"trade": normalize.trades, "kline": normalize.bars, "book": normalize.books}


def _typed(raw: DataFrame, kinds: Sequence[str], place: bool = False) -> DataFrame:
    """Typed events of the wanted kinds with where each came from, and ``place``: a struct that sorts as the replay does."""
    absent = {c: F.lit(None).cast("timestamp") for c in ("process_ts", "provider_ts", "receive_ts") if c not in raw.columns}
    rows = raw.withColumns(absent) if absent else raw
    order = F.struct(*[c.alias(f"k{k}") for k, c in enumerate(lake.replay_key(rows.columns))])
    rows = rows.withColumn("replay_place", order) if place else rows
    opened = normalize.open_envelope(rows)
    kept = ["receive_ts", "process_ts", "provider_ts", "run_id", "ingestion_seq", *(["replay_place"] if place else [])]
    out = None
    for kind in kinds:
        typed = KINDS[kind](opened, keep=kept if kind == "trade" else [c for c in kept if c != "provider_ts" or kind == "book"])
        typed = typed.withColumn("kind", F.lit(kind))
        out = typed if out is None else out.unionByName(typed, allowMissingColumns=True)
    return out.withColumn("process_ts", F.coalesce("process_ts", "receive_ts")).withColumnsRenamed({"run_id": "raw_run_id", "ingestion_seq": "raw_ingestion_seq"})


def trades(raw: DataFrame) -> DataFrame:
    """Typed trades of raw rows, with where each came from.

    process_ts is the raw row's, or else its receive time; provider_ts is the
    raw row's; raw_run_id and raw_ingestion_seq name the row. Messages that are
    no trades give no rows.
    """
    return _typed(raw, ["trade"]).drop("kind")


def replayed(raw: DataFrame, limit: int | None = None, kinds: Sequence[str] = ("trade",)) -> DataFrame:
    """Typed events of raw rows in replay order; with ``limit`` the first so many events of that order.

    Kinds are ``trade``, ``kline`` and ``book``; with more than one, rows have
    ``kind`` and the columns of all, null where a kind has none. Messages of
    other kinds, and bars that are not closed, give no rows and do not count.
    """
    out = _typed(raw, kinds, place=True).orderBy("replay_place")
    out = (out if limit is None else out.limit(limit)).drop("replay_place")
    return out if len(kinds) > 1 else out.drop("kind")
