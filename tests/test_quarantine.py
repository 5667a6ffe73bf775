"""Quarantined messages are replayed once, and those that fail again are counted."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidalbook.sources import quarantine


def test_replay_is_idempotent(spark):
    trade = {"e": "trade", "s": " btcusdt", "E": 5, "p": "1", "q": "2"}
    bar = {"e": "kline", "s": "ethusdt", "E": 5, "k": {"t": 1, "T": 2, "c": "5", "q": "1", "i": "1m", "h": "6", "l": "4"}}
    book = {"e": "bookTicker", "s": "x", "E": 3, "b": "4", "a": "3", "B": "1", "A": "1", "u": 1}
    said = [trade, {**trade, "p": "-1"}, {**trade, "p": None}, bar, {**bar, "k": {**bar["k"], "i": ""}}, book, {"e": "odd"}]
    rows = [(json.dumps(m), k, None, None, "t" if k < 2 else None) for k, m in enumerate(said)] + [("no json", 50, "abc", "TRADE", None), (None, 51, None, None, None), (json.dumps(trade), 60, None, None, "late")]
    held = quarantine.identified(spark.createDataFrame(rows, "payload string, quarantined_us bigint, symbol string, stream_type string, trace_id string").withColumns({"kind": F.lit("k"), "fields": F.lit(1)}))
    assert held.count() == 10
    assert quarantine.selected(held, symbol="btcusdt").count() == 4 and quarantine.selected(held, stream_type="kline").count() == 2
    assert quarantine.selected(held, trace_id="t", limit=1).first().quarantined_us == 0 and quarantine.selected(held, symbol="abc", stream_type="trade").count() == 1

    empty = spark.createDataFrame([], quarantine.LEDGER)
    first = quarantine.replay(held, empty, 7)
    assert sorted((r.kind, r.symbol) for r in first.events.collect()) == [("kline", "ETHUSDT"), ("trade", "BTCUSDT")]
    errors = {r.error for r in first.ledger.collect()}
    assert errors == {None, "bad_price", "missing_price", "missing_interval", "crossed", "no message of a known kind"}
    assert tuple(quarantine.report(first.ledger).first()) == (9, 2, 7, 0)

    ledger = spark.createDataFrame(first.ledger.collect(), quarantine.LEDGER)
    second = quarantine.replay(held, ledger, 8)
    assert second.events.count() == 0
    assert tuple(quarantine.report(second.ledger).first()) == (7, 0, 7, 7)
    assert {r.attempt for r in second.ledger.collect()} == {2}
    assert quarantine.replay(held.limit(0), ledger, 9).ledger.count() == 0


def test_a_record_is_read_and_parsed_once(spark, tmp_path):
    rows = [(json.dumps({"e": "trade", "s": "x", "E": k, "p": "1", "q": "2"}), k) for k in range(3)]
    spark.createDataFrame(rows, "payload string, quarantined_us bigint").write.parquet(str(tmp_path / "held"))
    rows = spark.read.parquet(str(tmp_path / "held"))
    assert quarantine.identified(rows)._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2
    out = quarantine.replay(rows.withColumn("record_id", quarantine.record_id(F.col("payload"))), spark.createDataFrame([], quarantine.LEDGER), 1)
    for df in (out.events, out.ledger):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 3 and plan.count("parquet") == 1
        assert df.count() == 3


def test_copies_are_one_record_and_kinds_keep_their_columns(spark):
    bar = json.dumps({"stream": "y@kline", "data": {"s": "y", "E": 5, "k": {"T": 9, "t": 1, "c": "5", "q": "1", "i": "1m"}}})
    book = json.dumps({"e": "bookTicker", "s": "z", "E": 3, "b": "4", "a": "6", "B": "1", "A": "1", "u": 1})
    rows = [(bar, k) for k in range(50)] + [(book, None), (book, 1), (None, 2), ("", 1), ('{"data":null,"e":"trade"}', 3)]
    out = quarantine.replay(quarantine.identified(spark.createDataFrame(rows, "payload string, quarantined_us bigint")), spark.createDataFrame([], quarantine.LEDGER), 1)
    events = {r.kind: r for r in out.events.collect()}
    assert sorted(events) == ["book", "kline"] and out.events.count() == 2
    assert (events["kline"].symbol, events["kline"].close, events["kline"].high, events["kline"].volume, events["kline"].interval, events["kline"].bid_price, events["kline"].price) == ("Y", 5.0, 5.0, 1.0, "1m", None, None)
    assert (events["book"].price, events["book"].ask_size, events["book"].sequence_id, events["book"].close, events["book"].size) == (5.0, 1.0, "1", None, None)
    assert sorted(r.error or "" for r in out.ledger.collect()) == ["", "", "missing_symbol,missing_exchange_ts,missing_price,missing_size", "no message of a known kind"]
