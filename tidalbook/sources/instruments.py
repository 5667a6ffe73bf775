"""Instrument snapshots: flatten, look up, stamp."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SNAPSHOT = "symbols array<struct<symbol:string,status:string,baseAsset:string,quoteAsset:string>>"


def flattened(snapshots: DataFrame, venue: str, symbols: Sequence[str] | None = None) -> DataFrame:
    """(venue, symbol, base, quote, status) of exchange listings in the column ``payload``; names in capitals."""
    each = snapshots.select(F.inline(F.from_json("payload", SNAPSHOT)["symbols"]))
    out = each.select(F.lit(venue.strip().upper()).alias("venue"), F.upper(F.trim("symbol")).alias("symbol"), F.col("baseAsset").alias("base"), F.col("quoteAsset").alias("quote"), "status")
    return out if symbols is None else out.where(F.col("symbol").isin([s.strip().upper() for s in symbols]))


RECORDS = "symbols array<struct<symbol:string,baseAsset:string,quoteAsset:string,filters:array<map<string,string>>>>"


def _filter_value(filters: str, kind: str, name: str) -> Column:
    """A field of the first filter of a kind; null where it is absent or empty."""
    of_kind = F.filter(filters, lambda f: F.upper(F.coalesce(F.try_element_at(f, F.lit("filterType")), F.lit(""))) == kind)
    return F.nullif(F.try_element_at(F.get(of_kind, F.lit(0)), F.lit(name)), F.lit(""))


def precision(increment: Column) -> Column:
    """Decimals of an increment such as 0.00100, without zeros at the end."""
    return F.when(F.contains(increment, F.lit(".")), F.char_length(F.regexp_extract(increment, r"\.([0-9]*?)0*$", 1))).otherwise(0)


def records(snapshots: DataFrame, venue: str, symbols: Sequence[str] | None = None, source: str = "venue_snapshot") -> DataFrame:
    """Spot instruments of exchange listings in the column ``payload``, with increments, precisions and the listing's version.

    Names and assets are in capitals; entries without a symbol are left out. The
    version is a digest of the listing, whatever the order of its keys. A listed
    instrument without a tick or step size is an error at run time; with
    ``symbols``, those that no listing has are an error at once.
    """
    version = F.substring(F.sha2(F.to_json(F.try_parse_json("payload")), 256), 1, 16)
    each = snapshots.select(version.alias("venue_snapshot_version"), F.inline(F.from_json("payload", RECORDS)["symbols"]))
    each = each.withColumn("symbol", F.upper("symbol")).where(F.coalesce("symbol", F.lit("")) != "")
    if symbols is not None:
        wanted = sorted({s.upper() for s in symbols})
        each = each.where(F.col("symbol").isin(wanted))
        missing = sorted(set(wanted) - {r["symbol"] for r in each.select("symbol").distinct().collect()})  # as many as were asked for at most
        if missing:
            raise KeyError(f"no listing has the instruments {missing}")
    told = lambda kind, name: F.coalesce(_filter_value("filters", kind, name), F.raise_error(F.concat(F.lit(f"missing {kind}.{name} for instrument "), "symbol")).cast("string"))
    out = each.withColumns({"tick_size": told("PRICE_FILTER", "tickSize"), "step_size": told("LOT_SIZE", "stepSize")})
    return out.select(
        F.lit(venue.strip().upper()).alias("venue"),
        "symbol",
        F.upper("baseAsset").alias("base"),
        F.upper("quoteAsset").alias("quote"),
        F.lit("spot").alias("contract_type"),
        "tick_size",
        "step_size",
        precision(F.col("tick_size")).alias("price_precision"),
        precision(F.col("step_size")).alias("size_precision"),
        F.lit(source).alias("metadata_source"),
        "venue_snapshot_version",
    )


def stamped(events: DataFrame, instruments: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """``events`` with the instrument's columns, by venue and symbol whatever their case.

    An unknown instrument is an error at run time, or with ``strict=False``
    gives nulls. Of repeated instruments the least row counts.
    """
    one = instruments.groupBy(F.upper(F.trim("venue")).alias("of_venue"), F.upper(F.trim("symbol")).alias("of_symbol")).agg(F.min(F.struct(*columns)).alias("of_row"))
    joined = events.join(one, (F.upper(F.trim("venue")) == F.col("of_venue")) & (F.upper(F.trim("symbol")) == F.col("of_symbol")), "left")
    known = F.when(F.col("of_row").isNotNull(), F.col("of_row"))
    if strict:
        known = known.otherwise(F.raise_error(F.concat(F.lit("unsupported instrument "), F.coalesce("venue", F.lit("")), F.lit(" "), F.coalesce("symbol", F.lit("")))))
    return joined.withColumn("of_row", known).select(*[events[c] for c in events.columns], *[F.col(f"of_row.{c}").alias(c) for c in columns])
