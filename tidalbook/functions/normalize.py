"""Exchange messages to typed rows: envelopes, trades, bars, books, schema drift."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.operators.scan import fresh

Normalizer = Callable[[DataFrame], DataFrame]
_normalizers: dict[str, Normalizer] = {}
VERSION = "v1"

# How feeds name their events, by canonical name.
EVENT_NAMES = {"trade": ("trade", "aggtrade"), "kline": ("kline",), "book": ("bookticker", "book")}
# Fields that each kind of message must have.
REQUIRED = {"trade": ("E", "s", "p", "q"), "kline": ("E", "s", "k.t", "k.T", "k.c"), "book": ("s", "b", "a")}


def register_normalizer(kind: str, fn: Normalizer) -> None:
    """Use ``fn`` for messages of this kind."""
    _normalizers[kind] = fn


def _text(path: str) -> Column:
    """A field of the parsed body, or after ``k.`` of its bar (see ``open_bar``); names differ by case, so both are maps and no structs."""
    first, _, rest = path.partition(".")
    return F.try_element_at("bar_fields", F.lit(rest)) if rest else F.try_element_at("fields", F.lit(first))


def _double(path: str) -> Column:
    return _text(path).try_cast("double")


def _ms(path: str) -> Column:
    return F.timestamp_millis(_text(path).try_cast("bigint"))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Rows with the column ``name``, which is computed once a row whatever asks for it.

    A plain column would be written out again in each filter and field that
    reads it, and Spark moves filters below plain columns but not below a generator.
    """
    return rows.withColumn(name, F.explode(F.array(value)))


def open_envelope(messages: DataFrame) -> DataFrame:
    """Add body (the ``data`` part or the whole), its fields, stream, and kind (canonical, null if unknown).

    What is no JSON object has no fields. Message and body are parsed once each.
    """
    (whole,) = fresh(messages.columns, "whole")
    outer = _once(messages, whole, F.from_json("payload", "map<string,string>"))
    data = F.try_element_at(whole, F.lit("data"))
    out = _once(outer, "fields", F.when(data.isNotNull(), F.from_json(data, "map<string,string>")).otherwise(F.col(whole)))
    out = out.withColumns({"body": F.coalesce(data, F.col("payload")), "stream": F.try_element_at(whole, F.lit("stream"))}).drop(whole)
    said = F.lower(F.coalesce(_text("e"), F.regexp_extract("stream", "@([A-Za-z]+)", 1)))
    kind = F.when(F.lit(False), F.lit(None).cast("string"))
    for canonical, names in EVENT_NAMES.items():
        kind = kind.when(said.isin(*names), canonical)
    return out.withColumn("kind", kind)


def open_bar(opened: DataFrame) -> DataFrame:
    """Add bar_fields: the fields of a bar's own part, parsed once; null in messages of other kinds."""
    return _once(opened, "bar_fields", F.when(F.col("kind") == "kline", F.from_json(_text("k"), "map<string,string>")))


def _event(exchange_ts: Column, **rest: Column) -> dict[str, Column]:
    return {"symbol": F.upper(F.trim(_text("s"))), "exchange_ts": exchange_ts, **rest, "normalizer_version": F.lit(VERSION)}


def trade_columns() -> dict[str, Column]:
    maker = F.lower(_text("m"))
    return _event(
        _ms("E"),
        price=_double("p"),
        size=_double("q"),
        trade_id=F.coalesce(_text("a"), _text("t")),
        side=F.when(maker == "true", "sell").when(maker == "false", "buy"),
    )


def bar_columns() -> dict[str, Column]:
    """Of messages whose bar is open."""
    return _event(
        F.coalesce(_ms("k.T"), _ms("E")),
        provider_ts=F.when(~_ms("E").eqNullSafe(_ms("k.T")), _ms("E")),
        open=F.coalesce(_double("k.o"), _double("k.c")),
        high=F.coalesce(_double("k.h"), _double("k.c")),
        low=F.coalesce(_double("k.l"), _double("k.c")),
        close=_double("k.c"),
        volume=_double("k.q"),
        interval=_text("k.i"),
        open_ts=_ms("k.t"),
        close_ts=_ms("k.T"),
    )


def book_columns(received: Column | None = None) -> dict[str, Column]:
    """``received`` stands in for a time that a quote has not."""
    bid, ask = _double("b"), _double("a")
    return _event(
        F.coalesce(_ms("E"), F.lit(None).cast("timestamp") if received is None else received),
        bid_price=bid,
        bid_size=_double("B"),
        ask_price=ask,
        ask_size=_double("A"),
        sequence_id=_text("u"),
        price=F.when((bid != 0) & (ask != 0), (bid + ask) / 2).when(bid != 0, bid).otherwise(ask),
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def trades(opened: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed trades, with the columns ``keep``; the buyer as maker means that the taker sold."""
    return opened.where("kind = 'trade'").select(*_named(trade_columns()), *keep)


def bars(opened: DataFrame, closed_only: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Typed bars, with the columns ``keep``; open, high and low stand in for by the close, the volume is the quote's."""
    rows = open_bar(opened.where("kind = 'kline'"))
    if closed_only:
        rows = rows.where(F.coalesce(F.lower(_text("k.x")), F.lit("true")) != "false")
    return rows.select(*_named(bar_columns()), *keep)


def books(opened: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed top-of-book quotes, with the columns ``keep``; price is the mean where both sides are set, else the set one."""
    received = F.col("receive_ts") if "receive_ts" in opened.columns else None
    return opened.where("kind = 'book'").select(*_named(book_columns(received)), *keep)


def normalize(messages: DataFrame) -> dict[str, DataFrame]:
    """Typed rows by kind; registered normalizers come before the built-in ones."""
    opened = open_envelope(messages)
    built_in: dict[str, Normalizer] = {"trade": trades, "kline": bars, "book": books}
    return {kind: fn(opened) for kind, fn in {**built_in, **_normalizers}.items()}


def _paths() -> Column:
    """Names of the body's fields, without those that begin with ``_``."""
    return F.filter(F.coalesce(F.json_object_keys("body"), F.array().cast("array<string>")), lambda k: ~k.startswith("_"))


def schema_drift(opened: DataFrame, expected: dict[str, tuple[str, ...]]) -> DataFrame:
    """Add unexpected and drifted: fields that a kind's messages should not have.

    A message drifts if it has an unexpected field and at least one required
    one; one that only lacks fields does not drift here.
    """
    known = F.when(F.lit(False), F.array(F.lit("")))
    needed = F.when(F.lit(False), F.array(F.lit("")))
    for kind, names in expected.items():
        known = known.when(F.col("kind") == kind, F.array(*map(F.lit, names)))
        needed = needed.when(F.col("kind") == kind, F.array(*[F.lit(n.split(".")[0]) for n in REQUIRED[kind]]))
    paths = _paths()
    unexpected = F.array_sort(F.array_except(paths, known))
    return opened.withColumn("unexpected", unexpected).withColumn("drifted", F.coalesce((F.size(unexpected) > 0) & F.arrays_overlap(paths, needed), F.lit(False)))


def shape_hash(body: Column) -> Column:
    """Short hash of a message's field names, whatever its values are."""
    return F.substring(F.sha2(F.array_join(F.array_sort(F.json_object_keys(body)), ","), 256), 1, 16)
