"""Contract records, their registry over time, replay parity and promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidalbook.sources import contracts

WHOLE = {k: "x" for k in (*contracts.KEYS, *contracts.STRICT_KEYS)} | {contracts.FEED_KIND: "aggregate_trade"}


def trades(spark, rows):
    """(symbol, n, metadata, feed kind, run) as normalized trades."""
    df = spark.createDataFrame(rows, "symbol string, n bigint, metadata map<string,string>, historical_feed_kind string, raw_run_id string")
    more = [c for c in contracts.required("trade")[0] if c not in df.columns]
    return df.withColumns({c: F.lit("x") for c in [*more, "row_count", "first"]})


def test_records_say_what_is_missing(spark):
    less = {k: v for k, v in WHOLE.items() if k != "raw_run_id"} | {"metadata_source": ""}
    old = {k: v for k, v in WHOLE.items() if k not in contracts.STRICT_KEYS}
    rows = trades(spark, [("a", 2, None, None, "z"), ("a", 1, WHOLE, None, "r"), ("b", 1, less, None, "r"), ("c", 1, old, " ", "r"), ("d", 1, WHOLE, "raw_trade", "r"), (None, 1, None, None, None)])
    strict = {r.symbol: r for r in contracts.records(rows, ["n"], partition=["symbol"]).collect()}
    assert strict["a"].pass_ok and strict["a"].row_count == 2 and list(strict["a"].missing_columns) == []
    assert strict["b"].missing_keys == ["metadata_source", "raw_run_id"] and not strict["b"].pass_ok
    assert not strict["d"].kind_ok and not strict["d"].pass_ok and strict["d"].historical_feed_kind == "raw_trade"
    assert not strict[None].pass_ok and strict[None].missing_keys == contracts.required("trade")[1]
    compat = {r.symbol: r.pass_ok for r in contracts.records(rows, ["n"], contracts.COMPAT, ["symbol"]).collect()}
    assert compat == {"a": True, "b": False, "c": True, "d": False, None: False} and not strict["c"].pass_ok

    bars = spark.createDataFrame([(1, "s", 1, 1, 1, 1, 1)], "n int, symbol string, open int, high int, low int, close int, volume int")
    bar = contracts.records(bars, ["n"], partition=["symbol"]).first()
    assert bar.stream_type == "kline" and "interval" in bar.missing_columns and "open" not in bar.missing_columns and bar.kind_ok
    assert contracts.feed_of(["x"]) == "unknown" and contracts.records(rows.limit(0), ["n"], partition=["symbol"]).count() == 0


def test_registry_can_be_asked_as_of_a_time(spark):
    first = contracts.records(trades(spark, [("a", 1, WHOLE, None, "r"), ("b", 1, WHOLE, None, "r"), ("c", 1, WHOLE, None, "r")]), ["n"], partition=["symbol"])
    then = contracts.records(trades(spark, [("a", 1, WHOLE, None, "r"), ("b", 1, {}, None, "r"), ("d", 1, WHOLE, None, "r")]), ["n"], partition=["symbol"])
    part = contracts.merged(contracts.merged(None, first, 10), then.union(then), 20)
    whole = contracts.merged(contracts.merged(None, first, 10), then, 20, whole=True)
    spans = lambda df: sorted((r.symbol, r.pass_ok, r.valid_from_us, r.valid_to_us) for r in df.collect())
    assert spans(part) == [("a", True, 10, None), ("b", False, 20, None), ("b", True, 10, 20), ("c", True, 10, None), ("d", True, 20, None)]
    assert ("c", True, 10, 20) in spans(whole) and len(spans(whole)) == 5
    at = lambda df, us: {r.symbol: r.pass_ok for r in contracts.as_of(df, us).collect()}
    assert at(whole, 9) == {} and at(whole, 19) == {"a": True, "b": True, "c": True} and at(whole, 20) == {"a": True, "b": False, "d": True}
    assert spans(contracts.merged(whole, then, 30)) == spans(whole)
    again = contracts.merged(whole, first.where("symbol = 'b'"), 20)
    assert at(again, 20)["b"] is True and again.where("symbol = 'b'").count() == 3


def test_parity_is_by_place(spark):
    rows = lambda data: spark.createDataFrame(data, "p string, k string, n int")
    stored = rows([("x", "1", 1), ("x", "2", 2), ("x", "3", 3), ("y", "1", 1), (None, "1", 1), ("gone", "1", 1)])
    replayed = rows([("x", "1", 1), ("x", "3", 2), ("x", "2", 3), ("x", "1", 4), ("y", "1", 1), ("y", "1", 2), (None, "1", 9), ("new", None, 1)])
    for width in (None, 2):
        found = {r.p: (r.replayed, r.stored, r.differing) for r in contracts.parity(replayed, stored, ["p"], "k", ["n", "k"], width).collect()}
        assert found == {"x": (3, 3, 2), "y": (1, 1, 0), None: (1, 1, 0), "gone": (0, 1, 1), "new": (1, 0, 1)}


def test_promotion_and_use(spark):
    old = {k: v for k, v in WHOLE.items() if k not in contracts.STRICT_KEYS}
    rows = trades(spark, [("a", 1, WHOLE, None, "r"), ("b", 1, old, None, "r"), ("c", 1, {}, None, "r"), ("e", 1, WHOLE, None, "r"), ("f", 1, WHOLE, None, "r")])
    strict, compat = (contracts.records(rows, ["n"], mode, ["symbol"]) for mode in (contracts.STRICT, contracts.COMPAT))
    differing = contracts.parity(rows.where("symbol <> 'e'"), rows.where("symbol <> 'f'"), ["symbol"], "n", ["n"])
    reports = contracts.promotions(strict, compat, differing, "paper", ["symbol"])
    reasons = {r.symbol: r.reasons for r in reports.collect()}
    assert reasons == {"a": [], "b": [contracts.REASON_COMPAT_ONLY], "c": [contracts.REASON_CONTRACT], "e": [contracts.REASON_PARITY], "f": [contracts.REASON_PARITY]}
    asked = contracts.promotions(strict, compat, differing, "paper", ["symbol"], contracts.COMPAT)
    assert asked.where("promoted").count() == 0 and asked.where("symbol = 'a'").first().reasons == [contracts.REASON_COMPAT_ASKED]
    alone = contracts.promotions(strict, compat, differing.limit(0), "paper", ["symbol"])
    assert alone.where("promoted").count() == 0

    registry = contracts.approved(None, reports, 5)
    assert [(r.dataset_id, r.registered_us, r.usages) for r in registry.collect()] == [("trade/symbol=a", 5, ["aggregate_trade"])]
    registry = contracts.approved(contracts.approved(registry, reports, 9), asked, 11)
    assert [r.registered_us for r in registry.collect()] == [9]
    uses = spark.createDataFrame([("paper", "trade/symbol=a", None), ("paper", "trade/symbol=a", "aggregate_trade"), ("paper", "trade/symbol=a", "raw_trade_history"), ("live", "trade/symbol=a", None), ("paper", "trade/symbol=b", "aggregate_trade"), ("paper", "trade/symbol=a", "odd")], "target string, dataset_id string, usage string")
    refused = {(r.target, r.dataset_id[-1], r.usage): r.reason for r in contracts.usage_refused(uses, registry).collect()}
    assert refused == {
        ("paper", "a", "raw_trade_history"): "aggregated trades are no raw trade history",
        ("live", "a", None): "not approved for the target",
        ("paper", "b", "aggregate_trade"): "not approved for the target",
        ("paper", "a", "odd"): "usage does not fit the feed kind",
    }
