"""Operators that no query reaches: stores, lake, replay files, streams, registries; and the cases that all must survive."""

from __future__ import annotations

import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows_of
from tidalbook.functions import normalize, scalars, validators
from tidalbook.operators import asof, dedup, gaps, quality, recovery, reports, scan
from tidalbook.plans import features, transformers
from tidalbook.plans.definitions import FeatureSet, Registry, default_set, node
from tidalbook.sources import events, instruments, lake, replay, runs
from tidalbook.sources.feature_store import FeatureStore
from tidalbook.streaming import stateful

EVENTS = "symbol string, available_us bigint, event_us bigint, arrival_seq bigint, price double, range string, chunk string, value_0 string"


def some_events(spark, n=60):
    """Two keys and a null one, ties, repeated rows, prices that are null, NaN, infinite or not positive, clashing columns."""
    odd = {7: None, 11: float("nan"), 13: float("inf"), 17: 0.0, 19: -2.0}
    rows = [(("A", "B", None)[k % 3], (k // 2) * 1_000_000, k * 1_000_000, k, odd.get(k, 10.0 + (k * 7) % 23), "r", "c", "v") for k in range(n)]
    return spark.createDataFrame([*rows, rows[5]], EVENTS)


GRAPH = (
    node("ret_1", "return", "price"),
    *[node(f"{a}_4", "rolling", "price", window=4, aggregator=a) for a in ("sma", "max", "min", "ema")],
    node("lag_2", "lag", "price", periods=2),
    node("z_3", "zscore", "price", window=3),
    node("vol_3", "volatility", "ret_1", window=3),
    node("sma_ret", "rolling", "ret_1", window=2, aggregator="sma"),
)


def test_features_do_not_depend_on_ranges_and_chunks(spark):
    found = [rows_of(features.compute(some_events(spark), FeatureSet("s", "v", GRAPH), width=w, chunk_rows=c)) for w, c in ((None, 1 << 16), (3_000_000, 8), (10**12, 16))]
    assert found[0] == found[1] == found[2]
    out = features.compute(some_events(spark), FeatureSet("s", "v", GRAPH))
    assert out.columns == [*some_events(spark).columns, *[n.name for n in sorted(GRAPH, key=lambda n: out.columns.index(n.name))]]
    assert out.count() == 58
    assert features.compute(some_events(spark).limit(0), FeatureSet("s", "v", GRAPH)).count() == 0


@pytest.mark.parametrize("what", ["sum", "max", "min", "count", "last"])
def test_running_values_equal_plain_windows(spark, what):
    order = ["arrival_seq", "price"]
    plain, cut = (scan.carry(some_events(spark), ["symbol"], order, {"got": (what, F.col("price"), own)}, w) for own, w in ((False, None), (False, 7)))
    assert rows_of(plain) == rows_of(cut)
    assert scan.carry(some_events(spark).limit(0), ["symbol"], order, {"got": (what, F.col("price"), True)}, 7).count() == 0


def test_operators_survive_empty_tables_and_clashing_names(spark):
    ev, none = some_events(spark), some_events(spark).limit(0)
    for df in (ev, none):
        assert gaps.detect_gaps(df, ["symbol"], 1.0, width=7).count() == df.count()
        assert gaps.cumulative_lateness(df, ["symbol"], width=7).count() == df.count()
        assert asof.recent(df, ["symbol"], 2).count() == (6 if df is ev else 0)
        assert asof.asof_join(df, df, ["symbol"], "available_us", "available_us", ("arrival_seq",), bucket_seconds=5).count() == df.count()
        assert quality.downsample(df, ["symbol"], ["arrival_seq"], 10, 7).count() <= df.count()
        assert dedup.keep_first(df, ["symbol"], ["arrival_seq"]).count() == (3 if df is ev else 0)


def test_store_keeps_its_rows_when_it_is_opened_again(spark, tmp_path):
    path = "file://" + str(tmp_path / "store")
    key = "entity_scope string, event_us bigint, feature_set_name string, feature_set_version string, lineage_id string, available_us bigint, arrival_seq bigint, price double"
    assert FeatureStore(spark, path).latest() is None
    FeatureStore(spark, path).put(spark.createDataFrame([("a", 1, "s", "v", "l", 1, 1, 1.0), ("a", 2, "s", "v", "l", 2, 2, 2.0)], key))
    FeatureStore(spark, path).put(spark.createDataFrame([("a", 1, "s", "v", "l", 1, 3, 9.0), ("b", 1, "s", "v", "l", 1, 4, 4.0)], key))
    again = FeatureStore(spark, path)
    assert again.version == 2
    assert sorted((r.entity_scope, r.event_us, r.price) for r in again.vectors().collect()) == [("a", 1, 9.0), ("a", 2, 2.0), ("b", 1, 4.0)]
    again.prune(now_us=10, ttl_us=100, keep=1)
    assert again.version == 3 and again.vectors().count() == 2


def test_lake_write_read_compact_health(spark, tmp_path):
    path = "file://" + str(tmp_path / "lake")
    day = events.synthetic_trades(spark, 20).withColumn("event_us", F.unix_micros("event_ts"))
    for part in (day.where("arrival_seq < 10"), day.where("arrival_seq >= 8")):
        lake.write_segments(lake.with_partitions(part, "paper", "binance").drop("env2"), path)
    assert lake.read_segments(spark, path).count() == 22
    assert lake.read_segments(spark, path, dedup_key=["arrival_seq"]).count() == 20
    assert [tuple(r)[:3] for r in lake.partitions(spark, path).collect()] == [("paper", "BINANCE", "BTCUSDT")]
    now = 4_000_000_000_000_000
    before = lake.health(spark, path, now)
    assert lake.compaction_candidates(before).count() == 1 and lake.health_totals(before).first().segments > 1
    lake.compact_in_place(spark, path, dedup_key=["arrival_seq"])
    assert lake.read_segments(spark, path).count() == 20
    assert lake.health_totals(lake.health(spark, path, now)).first().segments == 1


def test_raw_landing_window_replay_and_errors(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    trade = lambda k: json.dumps({"stream": "x@trade", "data": {"e": "trade", "E": 1_700_000_000_000 + k, "s": " btcusdt", "p": str(100 + k), "q": "1", "t": k, "m": bool(k % 2)}})
    line = lambda k, **more: json.dumps({"payload": trade(k), "venue": "BINANCE", "stream_type": "trade", "symbol": "BTCUSDT", "exchange_ts": f"2024-01-01T00:00:0{k}Z", "receive_ts": f"2024-01-01T00:00:1{k}Z", "run_id": "r", "ingestion_seq": 9 - k, **more})
    (folder / "a.json").write_text("\n".join([line(1), "{broken", "", line(2), line(3), line(4, run_id=None)]))
    good, broken = replay.read_window(spark, "file://" + str(folder), "2024-01-01 00:00:02", "2024-01-01 00:00:04", venue=["BINANCE"], symbol=None)
    assert good.count() == 3 and [r[0] for r in broken.collect()] == ["{broken"]
    got = replay.replayed(good).collect()
    assert [(r.price, r.side, r.raw_ingestion_seq) for r in got] == [(103.0, "sell", 6), (102.0, "buy", 7), (104.0, "buy", 5)]
    assert all(r.process_ts == r.receive_ts and r.symbol == "BTCUSDT" for r in got)
    assert replay.replayed(good, 1).count() == 1 and replay.replayed(good.limit(0)).count() == 0
    assert lake.ambiguous_order(good).count() == 1
    assert lake.replay_report(good).first()[0] == 3
    assert lake.raw_manifest(spark, "file://" + str(folder)).first().lines == 5


def test_lines_are_numbered_over_splits(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    want = {}
    for name, count in (("a", 4000), ("b", 1), ("c", 700), ("d", 0)):
        lines = ["" if k % 50 == 7 else f"{name} {k} " + "x" * (k % 90) for k in range(count)]
        (folder / f"{name}.txt").write_text("\n".join(lines) + ("\n" if name == "a" else ""))
        want |= {(f"{name}.txt", k + 1): line for k, line in enumerate(lines)}
    known = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = lake.numbered_lines(spark, "file://" + str(folder))
        assert got.rdd.getNumPartitions() > 8
        assert {(r.file.rsplit("/", 1)[1], r.line_no): r.value for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", known)


def test_replay_of_all_kinds_counts_events(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    at = lambda k: f"2024-01-01T00:00:{k:02d}Z"
    said = lambda body, k, **more: json.dumps({"payload": json.dumps({**body, "s": "x", "E": 1000 + k}), "receive_ts": at(k), **more})
    trade, book, odd = {"e": "trade", "p": "1", "q": "1"}, {"e": "bookTicker", "u": 4, "b": "1", "a": "3"}, {"e": "odd"}
    bar = lambda closed: {"e": "kline", "k": {"t": 1, "T": 2, "c": "5", "x": closed}}
    (folder / "b.json").write_text("\n".join([said(trade, 5), said(book, 5), said(trade, 1, run_id="r", ingestion_seq=2), said(odd, 0, run_id="r", ingestion_seq=1)]))
    (folder / "a.json").write_text("\n".join([said(bar(True), 5), "", said(bar(False), 1), said(trade, 5), said(book, 9, run_id="r")]))
    raw, broken = lake.read_raw(spark, "file://" + str(folder))
    assert broken.count() == 0
    kinds = ("trade", "kline", "book")
    order = [(r.kind, r.raw_ingestion_seq) for r in replay.replayed(raw, kinds=kinds).collect()]
    assert order == [("trade", 2), ("kline", None), ("trade", None), ("trade", None), ("book", None), ("book", None)]
    assert [r.kind for r in replay.replayed(raw, 3, kinds).collect()] == ["trade", "kline", "trade"]
    assert replay.replayed(raw, 2).count() == 2 and "kind" not in replay.replayed(raw, 2).columns
    assert replay.replayed(raw.limit(0), kinds=kinds).count() == 0


def test_bars_and_books_of_messages(spark):
    bar = {"e": "kline", "E": 2000, "s": "ethusdt", "k": {"t": 1000, "T": 1999, "i": "1m", "c": "5", "q": "7", "x": True, "h": "6"}}
    book = {"e": "bookTicker", "s": "ethusdt", "u": 4, "b": "1", "B": "2", "a": "3", "A": "4"}
    half = dict(book, a="0")
    rows = [(json.dumps(m),) for m in (bar, dict(bar, k=dict(bar["k"], x=False)), book, half, {"e": "odd"})] + [("no json",), (None,), ("[1]",)]
    opened = normalize.open_envelope(spark.createDataFrame(rows, "payload string"))
    (b,) = normalize.bars(opened).collect()
    assert (b.symbol, b.open, b.high, b.low, b.close, b.volume, b.interval) == ("ETHUSDT", 5.0, 6.0, 5.0, 5.0, 7.0, "1m")
    assert normalize.bars(opened, closed_only=False).count() == 2
    assert sorted(r.price for r in normalize.books(opened).collect()) == [1.0, 2.0]
    normalize.register_normalizer("odd", lambda df: df.where("kind is null"))
    assert normalize.normalize(spark.createDataFrame(rows, "payload string"))["odd"].count() == 4
    normalize._normalizers.pop("odd")


def test_payload_and_event_rules(spark):
    bars = spark.createDataFrame([(1, 2, None, None, None, 5.0, 1.0), (1, 2, 4.0, 6.0, 3.0, 7.0, -1.0), (2, 1, 4.0, 5.0, 3.0, 4.0, None)], "open_ms bigint, close_ms bigint, open double, high double, low double, close double, volume double")
    assert [r[0] for r in bars.select(validators.bar_reasons(10)).collect()] == [[], ["bad_volume", "high_not_highest"], ["missing_volume", "close_before_open"]]
    books = spark.createDataFrame([(1, 2.0, 1.0, 3.0, 1.0, None), (None, 4.0, float("nan"), 3.0, 1.0, 10**15)], "update_id bigint, bid double, bid_size double, ask double, ask_size double, event_ms bigint")
    assert [r[0] for r in books.select(validators.book_reasons(10)).collect()] == [[], ["missing_update_id", "bad_event_ms", "bad_bid_size", "crossed"]]
    trades = spark.createDataFrame([(1, 1.0, 1.0), (None, -1.0, None)], "event_ms bigint, price double, quantity double")
    good, bad = validators.split_valid(trades, validators.trade_reasons(10))
    assert good.count() == 1 and bad.first().reasons == ["missing_event_ms", "missing_quantity", "bad_price"]
    typed = spark.createDataFrame([(2, 1, 5.0, "")], "receive_us bigint, process_us bigint, price double, interval string")
    assert typed.select(validators.event_reasons(typed.columns)).first()[0] == ["processed_before_received", "missing_interval"]


def streamed(spark, tmp_path, df, parts, build, late=None):
    source, out = tmp_path / "in", tmp_path / "out"
    for k in range(parts):
        df.where(f"arrival_seq % {parts} = {k}" if late is None else late(k)).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    query = build(stream).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(str(out))


def test_stream_dedup_within_a_time_to_live(spark, tmp_path):
    rows = [(k, key, (1_000 + at) * 1_000_000) for k, (key, at) in enumerate([("a", 0), ("a", 10), ("b", 11), ("a", 300), ("a", 700), (None, 1), (None, 2)])]
    df = spark.createDataFrame(rows, "arrival_seq bigint, id string, event_us bigint").withColumn("event_ts", F.timestamp_micros("event_us"))
    got = streamed(spark, tmp_path, df, 1, lambda s: stateful.stream_dedup(s.withWatermark("event_ts", "1 hour"), "id"))
    assert sorted(r.arrival_seq for r in got.collect()) == [0, 2, 4, 5, 6]


def test_stream_dedup_forgets_behind_the_watermark(spark, tmp_path):
    rows = [(0, "a", 1000), (1, "a", 1010), (2, "b", 2000), (3, "b", 2001), (4, "a", 3000), (5, "a", 3005), (6, None, 3006), (7, None, 3007)]
    df = spark.createDataFrame([(n, key, at * 1_000_000, 5) for n, key, at in rows], "arrival_seq bigint, id string, event_us bigint, watermark_us bigint").withColumn("event_ts", F.timestamp_micros("event_us"))
    turn = lambda k: f"arrival_seq div 2 = {k}"
    got = streamed(spark, tmp_path / "marked", df, 4, lambda s: stateful.stream_dedup(s.withWatermark("event_ts", "10 seconds"), "id"), turn)
    assert sorted(r.arrival_seq for r in got.collect()) == [0, 2, 4, 6, 7]
    plain = streamed(spark, tmp_path / "plain", df, 4, lambda s: stateful.stream_dedup(s, "id"), turn)  # a column is no watermark
    assert sorted(r.arrival_seq for r in plain.collect()) == [0, 2, 4, 6, 7]


def test_ranges_by_counts(spark, monkeypatch):
    """One day with most rows, and sparse numbers: ranges hold about as many rows each, and results are those of plain windows."""
    hot = spark.range(3000).selectExpr("case when id < 2000 then 'A' when id < 2900 then 'B' end as symbol", "case when id % 5 = 0 then id * 86400000000 else 7 * 86400000000 + id end as event_us", "id as arrival_seq", "cast(id % 17 as double) as price")
    sparse = hot.withColumn("arrival_seq", F.xxhash64("arrival_seq"))
    monkeypatch.setattr(scan, "KEY_ROWS", 100)
    for df, order in ((hot, ["event_us", "arrival_seq"]), (sparse, ["arrival_seq", "event_us"])):
        bounds = scan.spread(df, ["symbol"], order)
        assert 10 < len(bounds) <= 30
        sizes = [r["count"] for r in df.groupBy("symbol", scan.range_of(F.col(order[0]), bounds).alias("range")).count().collect()]
        assert max(sizes) <= 250 and len(sizes) <= 3 * (len(bounds) + 1)
        values = {"total": ("sum", F.col("price"), True), "before": ("last", F.col("price"), False), "most": ("max", F.col("event_us"), False)}
        assert rows_of(scan.carry(df, ["symbol"], order, values, scan.AUTO)) == rows_of(scan.carry(df, ["symbol"], order, values))
    assert scan.spread(hot.limit(0), ["symbol"], ["event_us"]) is None
    monkeypatch.setattr(scan, "KEY_ROWS", 1 << 20)
    assert scan.spread(hot, ["symbol"], ["event_us"]) is None and scan.spread(hot, ["symbol"], ["event_us"], 5) == 5


@pytest.mark.parametrize(("capacity", "tolerance", "key_rows"), [(3, None, 1 << 20), (3, 40, 30), (1, None, 25), (50, 5, 40)])
def test_cached_lookup_equals_a_cache(spark, monkeypatch, capacity, tolerance, key_rows):
    rng = random.Random(capacity)
    rows = [(n, rng.choice(["A", "A", "A", "B", None]), rng.random() < 0.4, rng.choice([None, *range(20)]) if n % 9 == 0 else n // 2 + rng.randrange(-30, 30)) for n in range(400)]
    held, want = {}, {}
    for n, key, is_ask, at in rows:
        cache = held.setdefault(key, {})
        if is_ask:
            near = max((t for t in cache if at is not None and t <= at), default=None)
            want[n] = cache[near] if near is not None and (tolerance is None or at - near <= tolerance) else None
        elif at is not None:
            cache[at] = n
            if len(cache) > capacity:
                del cache[min(cache)]
    df = spark.createDataFrame(rows, "arrival_seq bigint, symbol string, is_ask boolean, at bigint").withColumns({"side": F.lit("s"), "put_row": F.lit(1)})
    monkeypatch.setattr(scan, "KEY_ROWS", key_rows)
    puts, asks = df.where("not is_ask").withColumnRenamed("at", "event_us"), df.where("is_ask")
    got = asof.cached_lookup(puts, asks, ["symbol"], "event_us", "at", capacity, tolerance_us=tolerance)
    assert {r.arrival_seq: r.found and r.found.arrival_seq for r in got.collect()} == want
    assert got.columns == [*asks.columns, "found"]
    assert asof.cached_lookup(puts.limit(0), asks, ["symbol"], "event_us", "at", 2).where("found is not null").count() == 0
    assert asof.cached_lookup(puts, asks.limit(0), ["symbol"], "event_us", "at", 2).count() == 0


def test_instrument_records(spark):
    entry = lambda symbol, tick="0.01000000", step="1": {"symbol": symbol, "baseAsset": "btc", "quoteAsset": "Usdt", "filters": [{"filterType": "OTHER"}, {"filterType": "price_filter", "tickSize": tick}, {"filterType": "LOT_SIZE", "stepSize": step}]}
    listing = {"b": 1, "a": [1, 2], "symbols": [entry("btcusdt"), entry("ethusdt", "0.5", "0.000100"), entry("", "1"), entry("odd", "")]}
    df = lambda one: spark.createDataFrame([(json.dumps(one),)], "payload string")
    got = {r.symbol: r for r in instruments.records(df(listing), "binance", ["BtcUsdt", "ETHUSDT"]).collect()}
    assert {k: (r.base, r.quote, r.tick_size, r.step_size, r.price_precision, r.size_precision) for k, r in got.items()} == {"BTCUSDT": ("BTC", "USDT", "0.01000000", "1", 2, 0), "ETHUSDT": ("BTC", "USDT", "0.5", "0.000100", 1, 4)}
    version = hashlib.sha256(json.dumps(listing, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]
    assert {r.venue_snapshot_version for r in got.values()} == {version}
    assert instruments.records(df(dict(reversed(listing.items()))), "binance", ["btcusdt"]).first().venue_snapshot_version == version
    with pytest.raises(KeyError, match="XRP"):
        instruments.records(df(listing), "binance", ["btcusdt", "xrp"])
    with pytest.raises(Exception, match="missing PRICE_FILTER.tickSize for instrument ODD"):
        instruments.records(df(listing), "binance").collect()


def test_recovered_rows_that_were_asked_for(spark, monkeypatch):
    rng = random.Random(3)
    wanted = [("a", 5, 9), ("a", 7, 7), ("b", 20, 10**15), (None, 1, 2)] + [("c", k, k + rng.randrange(4)) for k in range(0, 200, 9)]
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(30)]) if n % 2 else rng.randrange(220), n) for n in range(300)]
    df = spark.createDataFrame(rows, "symbol string, cursor bigint, is_row int")
    asks = spark.createDataFrame(wanted, "symbol string, first bigint, last bigint")
    want = sorted(n for key, c, n in rows if c is not None and any(key == k and low <= c <= high for k, low, high in wanted))
    for key_rows in (1 << 20, 20):
        monkeypatch.setattr(scan, "KEY_ROWS", key_rows)
        got = recovery.asked_for(df, asks, ["symbol"])
        assert sorted(r.is_row for r in got.collect()) == want and got.columns == df.columns
    assert recovery.asked_for(df, asks.limit(0), ["symbol"]).count() == 0


def test_names_that_clash_and_null_datasets(spark):
    odd = some_events(spark).withColumns({"_high": F.lit(1), "time_before": F.lit(2), "_bar": F.lit(3), "_cursor": F.lit(4), "_n": F.lit(5)})
    assert set(odd.columns) <= set(gaps.detect_gaps(odd, ["symbol"], 1.0).columns)
    report = quality.quality_report(odd, ["symbol"], ["event_us"], "range", "chunk", "event_us", ["arrival_seq"])
    assert sorted(str(r.symbol) for r in report.collect()) == ["A", "B", "None"]


def test_stream_late_rows_and_features_equal_batch(spark, tmp_path):
    df = spark.createDataFrame([(k, "ab"[k % 2], (k if k != 7 else 1) * 1_000_000, 10.0 + (k * 5) % 7) for k in range(24)], "arrival_seq bigint, symbol string, event_us bigint, price double")
    late = lambda k: f"arrival_seq div 12 = {k}"
    got = streamed(spark, tmp_path / "late", df, 2, lambda s: stateful.stream_late(s, ["symbol"]), late)
    assert [r.arrival_seq for r in got.where("late").collect()] == [7]
    made = streamed(spark, tmp_path / "made", df, 2, lambda s: stateful.stream_features(s, ["symbol"], (3,)), late)
    graph = [node("ret_1", "return", "price"), *[node(f"{a}_3", "rolling", "price", window=3, aggregator=a) for a in ("sma", "max", "min", "ema")]]
    want = features.compute(df, FeatureSet("s", "v", tuple(graph)), order=["arrival_seq"], width=5)
    names = ["arrival_seq", "ret_1", "sma_3", "max_3", "min_3", "ema_3"]
    assert rows_of(made.select(names)) == rows_of(want.select(names))


def test_registries_refuse_other_definitions_and_roll_back(spark):
    known = Registry()
    for version in ("v1", "v2"):
        known.register(default_set(version=version))
        known.activate("default", version)
    with pytest.raises(ValueError):
        known.register(default_set((2,), version="v1"))
    assert known.active("default").version == "v2" and known.rollback("default") == "v1"
    with pytest.raises(ValueError):
        known.rollback("default")
    features.register_aggregator("span", lambda value, frame: F.max(value).over(frame) - F.min(value).over(frame))
    out = features.compute(some_events(spark), FeatureSet("s", "v", (node("span_2", "rolling", "price", window=2, aggregator="span"),)))
    assert out.where("span_2 is not null and span_2 >= 0").count() == 55
    with pytest.raises(ValueError):
        transformers.transformed(some_events(spark), ["unknown"])


def test_summaries_of_nothing_and_unknown_instruments(spark):
    assert tuple(reports.shadow_summary(spark.createDataFrame([], "pass_ok boolean, severity string")).first()) == (0, 0, 0, 0, 0, True)
    assert reports.probe_summary(spark.createDataFrame([(None, None)], "status string, seconds double")).first().unknown_count == 1
    assert tuple(runs.record(spark.createDataFrame([], "event_us bigint"), "r", "d", "f").first())[5:] == (0, None, None)
    listing = spark.createDataFrame([('{"symbols":[{"symbol":"btcusdt","baseAsset":"BTC"}]}',), ("broken",)], "payload string")
    some = spark.createDataFrame([("binance", "BTCUSDT"), ("x", None)], "venue string, symbol string")
    found = instruments.flattened(listing, "Binance")
    assert sorted(str(r.base) for r in instruments.stamped(some, found, ["base"], strict=False).collect()) == ["BTC", "None"]
    with pytest.raises(Exception, match="unsupported instrument"):
        instruments.stamped(some, found, ["base"]).collect()
    cursor = recovery.trade_cursor(F.lit(None), F.lit("x"), F.lit("12"))
    assert spark.range(1).select(cursor).first()[0] == 12
    assert math.isclose(spark.range(1).select(scalars.interval_seconds(F.lit("5m"))).first()[0], 300)
    assert events.market_events(spark, SMALL).count() == 1000
