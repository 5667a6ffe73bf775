"""Price jumps and volume spikes against the event before."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalbook.operators.scan import AUTO, Width, last_before, spread

TIERS = ("warn", "quarantine", "fail")
# Thresholds of each feed, from warn to fail, for price jumps and volume spikes.
THRESHOLDS = {
    "trade": ((0.20, 0.35, 0.60), (8.0, 20.0, 50.0)),
    "kline": ((0.15, 0.30, 0.50), (4.0, 10.0, 20.0)),
    "book": ((0.10, 0.20, 0.35), (4.0, 8.0, 15.0)),
}


def _rank(ratio: Column, feed: Column, which: int) -> Column:
    """0 for nothing, then 1 to 3 by tier; feeds without thresholds go by those of trades."""
    def tiers(limits: Sequence[float]) -> Column:
        return F.when(ratio >= limits[2], 3).when(ratio >= limits[1], 2).when(ratio >= limits[0], 1).otherwise(0)

    kind = F.lower(F.trim(feed))
    out = F.when(kind == "kline", tiers(THRESHOLDS["kline"][which])).when(kind == "book", tiers(THRESHOLDS["book"][which]))
    return F.coalesce(out.otherwise(tiers(THRESHOLDS["trade"][which])), F.lit(0))


def mark_anomalies(events: DataFrame, keys: Sequence[str], order: Sequence[str] = ("arrival_seq",), volume: str = "size", width: Width = AUTO) -> DataFrame:
    """Add jump, jump_tier, spike, spike_tier and dominant to each row.

    Each row is compared with the row before of its key. Trades have no spike.
    dominant is the graver of the two, the jump if they are equal.
    """
    out = last_before(events, keys, order, F.struct("price", F.col(volume).alias("volume")), "_before", spread(events, keys, order, width))
    jump = F.when(F.col("_before.price") != 0, F.abs(F.col("price") - F.col("_before.price")) / F.abs("_before.price"))
    spike = F.when((F.lower("source") != "trade") & (F.col("_before.volume") != 0) & (F.col(volume) != 0), F.abs(F.col(volume)) / F.abs("_before.volume"))
    out = out.withColumns({"jump": jump, "spike": spike})
    out = out.withColumns({"_j": _rank(F.col("jump"), F.col("source"), 0), "_s": _rank(F.col("spike"), F.col("source"), 1)})
    name = lambda c: F.when(F.col(c) > 0, F.element_at(F.array(*map(F.lit, TIERS)), F.greatest(F.col(c), F.lit(1))))
    worst = F.when((F.col("_j") == 0) & (F.col("_s") == 0), F.lit(None)).when(F.col("_j") >= F.col("_s"), F.concat(F.lit("price_jump:"), name("_j"))).otherwise(F.concat(F.lit("volume_spike:"), name("_s")))
    return out.withColumns({"jump_tier": name("_j"), "spike_tier": name("_s"), "dominant": worst}).drop("_before", "_j", "_s")


def _tier(ratio: float | None, limits: Sequence[float]) -> int:
    return 0 if ratio is None else sum(ratio >= limit for limit in limits)


def accept_loop(events: DataFrame, keys: Sequence[str], order: Sequence[str] = ("arrival_seq",), volume: str = "size") -> DataFrame:
    """Add decision (accept, warn, quarantine or fail): price and volume before advance only on accepted rows.

    A row's reference is the last accepted row, which depends on all decisions
    before, so rows of a key are taken in order: Arrow batches of the sorted
    partition with one state per key, in bounded memory.
    """
    places = [events.columns.index(k) for k in keys]
    price_at, volume_at, source_at = (events.columns.index(c) for c in ("price", volume, "source"))
    schema = T.StructType([*events.schema.fields, T.StructField("decision", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: object = None
        last_price = last_volume = None
        for batch in batches:
            out = []
            columns = [batch.column(p).to_pylist() for p in (*places, price_at, volume_at, source_at)]
            for *key, price, size, source in zip(*columns, strict=True):
                if key != at:
                    at, last_price, last_volume = key, None, None
                feed = (source or "").strip().lower()
                jumps, spikes = THRESHOLDS.get(feed, THRESHOLDS["trade"])
                jump = abs(price - last_price) / abs(last_price) if last_price and price is not None else None
                spike = abs(size) / abs(last_volume) if feed != "trade" and last_volume and size else None
                tier = max(_tier(jump, jumps), _tier(spike, spikes))
                out.append(("accept", *TIERS)[tier])
                if tier <= 1:
                    last_price = price
                    last_volume = size if size is not None else last_volume
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decision"])

    return events.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
