"""What no query reaches: landing, routing, identities, journals, gates, audits, back-pressure."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_operators import some_events
from tidalbook.functions import normalize, scalars, validators
from tidalbook.operators import asof, compare, dedup, gaps, quality
from tidalbook.plans import features, trading
from tidalbook.plans.definitions import FeatureSet, node
from tidalbook.sources import feature_store, lake, runs
from tidalbook.streaming import stateful


def test_landing_and_routing(spark, tmp_path):
    path = "file://" + str(tmp_path / "raw")
    rows = spark.createDataFrame([("{}", "v", "r", 1), (None, "v", None, 2)], "payload string, venue string, run_id string, ingestion_seq bigint")
    for _ in range(2):
        lake.write_raw(rows, path)
    good, broken = lake.read_raw(spark, path)
    assert good.count() == 4 and broken.count() == 0
    assert {r.line_no for r in good.collect()} <= {1, 2}
    refused = spark.createDataFrame([(1, "schema_drift", "p"), (2, "bad_price", "p"), (3, "bad_price", None), (4, None, None)], "n int, reason string, quarantine_path string")
    assert {k: sorted(r.n for r in df.collect()) for k, df in lake.route_errors(refused).items()} == {"schema_drift": [1], "quarantine": [2], "default": [3, 4]}


def test_identities(spark):
    df = spark.createDataFrame([("s", "BTC", "7", None, 1.0), ("s", "BTC", "7", "x", 2.0), ("s", "BTC", None, None, 1.0), ("own", "BTC", "8", None, 3.0), ("own", "ETH", "9", None, 3.0)], "source string, symbol string, trade_id string, source_id string, price double").withColumns({"event_us": F.lit(1), "size": F.lit(1.0), "arrival_seq": F.monotonically_increasing_id()})
    assert dedup.dedup_events(df).count() == 4
    dedup.register_identity("own", lambda rows: F.concat(F.lit("own|"), F.col("price").cast("string")))
    try:
        assert dedup.dedup_events(df).count() == 3
    finally:
        dedup._builders.pop("own")


def test_pairs_shapes_and_times(spark):
    pairs = spark.createDataFrame([("BTCUSDT",), ("ETHBTC",), ("USDT",), (None,)], "s string")
    base, quote = scalars.split_pair(F.col("s"), ("USDT", "BTC"))
    assert [tuple(r) for r in pairs.select(base, quote).collect()] == [("BTC", "USDT"), ("ETH", "BTC"), ("USDT", ""), (None, "")]
    shapes = spark.createDataFrame([('{"a":1,"b":2}',), ('{"b":"x","a":{}}',), ('{"a":1}',)], "p string").select(normalize.shape_hash(F.col("p"))).collect()
    assert shapes[0] == shapes[1] != shapes[2]
    gate = spark.createDataFrame([(1, True), (2, False)], "n int, explicit_availability boolean")
    assert [validators.strict_temporal(gate, strict).count() for strict in (True, False)] == [1, 2]


def test_journal_fingerprint_and_runs(spark):
    ev = some_events(spark)
    whole = feature_store.journal(feature_store.journal(None, ev), ev)
    assert whole.count() == 60  # one of its rows is a repeated one
    one, other = (feature_store.fingerprint(df, ["symbol", "arrival_seq"]).first() for df in (ev, ev.orderBy(F.desc("arrival_seq"))))
    assert one == other and one != feature_store.fingerprint(ev.limit(59), ["symbol", "arrival_seq"]).first()
    bundle = feature_store.bundle_id("d", "f", "r")
    assert bundle == hashlib.sha256(b"d|f|r").hexdigest()[:32]
    each = runs.record_each(ev.withColumn("run_id", F.when(F.col("symbol") == "A", "r")), "d", "f").collect()
    assert [(r.run_id, r.bundle_id, r.row_count) for r in each] == [("r", bundle, 20)]
    assert rows_of(runs.record_each(ev.withColumn("run_id", F.lit("r")), "d", "f")) == rows_of(runs.record(ev, "r", "d", "f"))


def test_features_of_metadata_vectors_and_audit(spark):
    ev = some_events(spark).withColumns({"said": F.when(F.col("arrival_seq") % 2 == 0, "1.5").otherwise("x"), "event_ts": F.timestamp_micros("event_us"), "available_ts": F.timestamp_micros("available_us")})
    graph = FeatureSet("s", "v", (node("told", "metadata", "said"), node("lag_1", "lag", "price")))
    made = features.compute(ev, graph)
    assert {(r.arrival_seq % 2, r.told) for r in made.collect()} == {(0, 1.5), (1, None)}
    vectors = features.as_vectors(made, graph)
    sizes = {len(r["values"]) for r in vectors.collect()}
    assert vectors.count() == made.count() and sizes <= {0, 1, 2}
    audit = trading.decision_audit(made, made.where("arrival_seq < 10").select("arrival_seq", F.lit("buy").alias("side")).distinct(), ["arrival_seq"])
    assert audit.count() == made.count() and audit.where("side = 'buy'").count() == made.where("arrival_seq < 10").count()


def test_differences_plans_contracts_and_aliases(spark):
    table = lambda rows: spark.createDataFrame(rows, "k string, name string, value double")
    found = compare.first_difference(table([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", None), ("c", "x", 1.0)]), table([("a", "x", 1.0), ("a", "y", 3.0), ("b", "x", None), ("d", "x", 1.0)]), ["k"])
    assert sorted(tuple(r) for r in found.collect()) == [("a", "value:medium", "y"), ("c", "missing:high", "x"), ("d", "missing:high", "x")]
    days = lambda *rows: spark.createDataFrame(rows, "k string, day string")
    assert sorted(tuple(r) for r in gaps.fill_plan(days(("a", "1"), ("a", "2")), days(("a", "2"), ("b", "1")), ["k"]).collect()) == [("a", "1"), ("a", "2"), ("b", "1")]
    assert quality.contract_reasons(["a", "z"], ["a", "b"], ["a", "b"]) == ["missing:b", "unexpected:z"]
    with pytest.raises(ValueError, match="missing"):
        asof.enrich(some_events(spark), {}, {}, ["aux"])


def test_micro_batches(spark):
    rows = spark.range(10).withColumnRenamed("id", "arrival_seq")
    assert [r[0] for r in stateful.capped(rows, 2).collect()] == [0, 1] and [r[0] for r in stateful.capped(rows, 2, "drop_oldest").collect()] == [9, 8]
    with pytest.raises(ValueError, match="unknown policy"):
        stateful.capped(rows, 2, "block")
    seen = []
    stateful.mirrored(lambda df, n: seen.append(("one", n, df.count())), lambda df, n: seen.append(("two", n, df.count())))(rows, 4)
    assert seen == [("one", 4, 10), ("two", 4, 10)]
    late = stateful.recomputed(some_events(spark), ["symbol"], spark.createDataFrame([("A",)], "symbol string"))
    assert late.count() == 20 and [r.available_us for r in late.collect()] == sorted(r.available_us for r in late.collect())
