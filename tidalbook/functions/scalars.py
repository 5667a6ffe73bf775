"""Column expressions: times, intervals, entity keys, hashes, signals, statuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of each interval unit.
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3_600, "d": 86_400, "w": 604_800, "M": 2_592_000}
# Quote assets, longest first where one ends another.
QUOTES = ("FDUSD", "USDT", "USDC", "BUSD", "TUSD", "BTC", "ETH", "BNB", "EUR", "TRY")


def interval_seconds(text: Column) -> Column:
    """Seconds of an interval such as 5m or 1h; null if it is none."""
    number = F.regexp_extract(text, r"^\s*([0-9]+)([smhdwM])\s*$", 1)
    unit = F.regexp_extract(text, r"^\s*([0-9]+)([smhdwM])\s*$", 2)
    size = F.when(F.lit(False), F.lit(0))
    for name, seconds in UNIT_SECONDS.items():
        size = size.when(unit == name, seconds)
    return F.when(number != "", number.cast("bigint")) * size


def normal_symbol(symbol: Column) -> Column:
    return F.upper(F.trim(symbol))


def split_pair(symbol: Column, quotes: Sequence[str] = QUOTES) -> tuple[Column, Column]:
    """(base, quote) of a spot symbol by its longest known quote suffix; quote is empty if none fits."""
    known = sorted(quotes, key=lambda q: (-len(q), q))
    quote = F.when(F.lit(False), F.lit(""))
    for q in known:
        quote = quote.when(symbol.endswith(q) & (F.length(symbol) > len(q)), F.lit(q))
    quote = quote.otherwise("")
    return F.substr(symbol, F.lit(1), F.length(symbol) - F.length(quote)), quote


def entity_scope(keys: Sequence[str]) -> Column:
    """Canonical JSON of entity keys: sorted names, symbol in capitals, the rest trimmed, blanks left out."""
    parts = []
    for name in sorted(keys):
        value = F.trim(F.col(name).cast("string"))
        value = F.nullif(F.upper(value) if name == "symbol" else value, F.lit(""))
        parts.append(F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), F.to_json(F.struct(value.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(value.alias("v")))) - 6))))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def in_canary(key: Column, fraction: float) -> Column:
    """True for the share ``fraction`` of keys, by the first 32 bits of their SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint") / F.lit(4294967295.0) < F.lit(fraction)


def signal(price: Column, average: Column, ret: Column) -> Column:
    """buy above the average on a gain, sell below it on a loss, else flat."""
    return F.when((price > average) & (ret > 0), "buy").when((price < average) & (ret < 0), "sell").otherwise("flat")


def serving_status(found: Column, age_seconds: Column, max_age: float, flags: Column, invalid_ratio: Column, max_ratio: float, contract_ok: Column, preflight_ok: Column | None = None) -> Column:
    """The first rule that a served vector breaks, or ok."""
    ready = F.lit(True) if preflight_ok is None else preflight_ok
    return (
        F.when(~ready, "preflight_failed")
        .when(~found, "missing")
        .when(age_seconds > max_age, "stale")
        .when(F.size(flags) > 0, "quality_flagged")
        .when(invalid_ratio > max_ratio, "invalid_ratio")
        .when(~contract_ok, "contract_mismatch")
        .otherwise("ok")
    )


def reasons(rules: Sequence[tuple[Column, str]]) -> Column:
    """The names of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for rule, name in rules]))
