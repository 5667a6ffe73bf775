"""Replay of quarantined messages against a ledger, so that each goes through once.

A record is known by the digest of its message. A replay takes the records that
the ledger does not call ``replayed``, tries to type and check them, and gives
the events that pass and a ledger row for each record that was tried: how it
ended, why, and the number of the attempt. Appending these rows to the ledger
makes the next replay leave out what passed and count up what did not.

Records with equal messages are one, the earliest by time. Null messages are
records with the digest of the empty message, and fail. Symbols and kinds are
read from the message where the record has none. Empty tables give empty tables.

All is joins and aggregates by digest; the ledger may be as large as the
quarantine. Of the ledger only one row a record is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.functions import normalize, validators

LEDGER = "record_id string, attempt bigint, status string, error string, tried_us bigint"
REPLAYED, FAILED = "replayed", "failed"
#: Columns without which an event of a kind is none.
NEEDED = {"trade": ("symbol", "exchange_ts", "price", "size"), "kline": ("symbol", "exchange_ts", "close", "volume"), "book": ("symbol", "exchange_ts", "bid_price", "ask_price")}
TYPED = {"trade": normalize.trade_columns, "kline": normalize.bar_columns, "book": normalize.book_columns}


@dataclass(frozen=True)
class Replayed:
    events: DataFrame
    ledger: DataFrame


def record_id(payload: Column) -> Column:
    return F.sha2(F.coalesce(payload, F.lit("")), 256)


def identified(quarantined: DataFrame) -> DataFrame:
    """Records (payload, reason, quarantined_us and, where known, symbol, stream_type, trace_id) with record_id and what the message tells of the rest."""
    out = quarantined.withColumns({c: F.lit(None).cast("string") for c in ("symbol", "stream_type", "trace_id") if c not in quarantined.columns})
    kept = {"symbol": "said_symbol", "stream_type": "said_type", "trace_id": "said_trace"}
    opened = normalize.open_envelope(out.withColumnsRenamed(kept).drop("fields", "body", "stream", "kind"))
    symbol = F.coalesce(F.upper(F.trim("said_symbol")), F.upper(F.trim(normalize._text("s"))))
    typed = F.coalesce(F.lower(F.trim("said_type")), F.col("kind"))
    rest = [c for c in out.columns if c not in (*kept, "record_id", "fields", "body", "stream", "kind")]
    return opened.select(record_id(F.col("payload")).alias("record_id"), *rest, symbol.alias("symbol"), typed.alias("stream_type"), F.col("said_trace").alias("trace_id"))


def selected(records: DataFrame, symbol: str | None = None, stream_type: str | None = None, trace_id: str | None = None, record: str | None = None, limit: int | None = None) -> DataFrame:
    """Records that meet all that is asked; with ``limit`` the first by time and digest."""
    out = records
    for column, value in (("symbol", symbol and symbol.upper()), ("stream_type", stream_type and stream_type.lower()), ("trace_id", trace_id), ("record_id", record)):
        if value:
            out = out.where(F.col(column) == value)
    return out if limit is None else out.orderBy("quarantined_us", "record_id").limit(limit)


def _by_kind(found: dict[str, Column]) -> Column:
    """For each row what its kind has; null for kinds that have nothing."""
    out = F.when(F.lit(False), F.lit(None))
    for kind, value in found.items():
        out = out.when(F.col("kind") == kind, value)
    return out


def _tried(pending: DataFrame) -> DataFrame:
    """Each record as a typed event of its kind, with record_id, attempts, kind and error: why it is none.

    One pass for all kinds, so that a record is read and parsed once.
    """
    opened = normalize.open_bar(normalize.open_envelope(pending))
    typed = {kind: columns() for kind, columns in TYPED.items()}
    names = dict.fromkeys(n for columns in typed.values() for n in columns)
    rows = opened.select("record_id", "attempts", "kind", *[_by_kind({k: columns[n] for k, columns in typed.items() if n in columns}).alias(n) for n in names])
    why = {}
    for kind, columns in typed.items():
        missing = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in NEEDED[kind]]
        why[kind] = F.concat_ws(",", *missing, validators.event_reasons(list(columns)))
    rows = rows.withColumn("why", _by_kind(why))
    return rows.withColumn("error", F.when(F.col("kind").isNull(), F.lit("no message of a known kind")).otherwise(F.nullif("why", F.lit("")))).drop("why")


def replay(records: DataFrame, ledger: DataFrame, now_us: int) -> Replayed:
    """Events of the records (from ``identified`` or ``selected``) that pass now, and the ledger rows of this attempt."""
    once = records.groupBy("record_id").agg(F.min(F.struct("quarantined_us", "payload")).alias("first"))
    known = ledger.groupBy(F.col("record_id").alias("known_id")).agg(F.max("attempt").alias("attempts"), F.bool_or(F.col("status") == REPLAYED).alias("done"))
    pending = once.join(known, F.col("record_id") == F.col("known_id"), "left").where(~F.coalesce("done", F.lit(False)))
    tried = _tried(pending.select("record_id", "attempts", "first.payload"))
    status = F.when(F.col("error").isNull(), REPLAYED).otherwise(FAILED)
    attempt = (F.coalesce("attempts", F.lit(0)) + 1).cast("bigint")
    written = tried.select("record_id", attempt.alias("attempt"), status.alias("status"), "error", F.lit(now_us).cast("bigint").alias("tried_us"))
    return Replayed(tried.where(F.col("error").isNull()).drop("error", "attempts"), written)


def report(written: DataFrame) -> DataFrame:
    """(inspected, replayed, failed, again): of one replay; again counts those that failed before, too."""
    return written.agg(
        F.count("*").alias("inspected"),
        F.count_if(F.col("status") == REPLAYED).alias("replayed"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.count_if((F.col("status") == FAILED) & (F.col("attempt") > 1)).alias("again"),
    )
