"""Delta recompute, nested drift and gap recovery in the stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_operators import GRAPH, some_events
from tidalbook.functions import normalize, shapes
from tidalbook.plans import features, recompute
from tidalbook.plans.definitions import FeatureSet, node
from tidalbook.streaming import reorder

UNSOUND = (node("lag_1", "lag", "price"), node("rel", "ratio", "price", "lag_1"), node("z_rel", "zscore", "rel", window=3))


FEW = tuple(n for n in GRAPH if n.name in ("ret_1", "ema_4", "vol_3", "sma_ret"))


@pytest.mark.parametrize(("graph", "late"), [(GRAPH, "arrival_seq in (0, 20, 41)"), (FEW, "arrival_seq % 50 = 9 or symbol is null"), (FEW, "false"), (FEW, "true"), (UNSOUND, "arrival_seq in (7, 90)")])
def test_recompute_equals_a_full_run(spark, graph, late):
    events = some_events(spark, 400)
    feature_set = FeatureSet("s", "v", graph)
    made = features.compute(events.where(f"not ({late})"), feature_set)
    got = recompute.recompute(made, events.where(late), feature_set)
    assert rows_of(got.drop("recomputed")) == rows_of(features.compute(events, feature_set))


def test_recompute_touches_little(spark):
    events = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("symbol"), (F.col("id") * 1_000_000).alias("available_us"), (F.col("id") * 1_000_000).alias("event_us"), F.col("id").alias("arrival_seq"), (10 + F.col("id") % 7).cast("double").alias("price"))
    feature_set = FeatureSet("s", "v", (node("ret_1", "return", "price"), node("sma_20", "rolling", "price", window=20, aggregator="sma"), node("vol_4", "volatility", "ret_1", window=4)))
    assert recompute.reach(feature_set) == 21
    made = features.compute(events.where("arrival_seq <> 3000"), feature_set)
    got = recompute.recompute(made, events.where("arrival_seq = 3000"), feature_set)
    assert rows_of(got.drop("recomputed")) == rows_of(features.compute(events, feature_set))
    assert got.where("recomputed").count() == 42 and got.where("recomputed and symbol = 'B'").count() == 0
    again = recompute.recompute(got, events.where("false"), feature_set)
    assert again.where("recomputed").count() == 0 and again.columns == got.columns


def test_paths_of_shapes(spark):
    texts = [{"b": 1, "a": "x", "k": {"c": 1.5, "b": [1, {"z": 2}], "z": None, "Q": True}}, {"a b": {"`q": 1, "x,y": 2.25, "é<>": {}}, "e": 1e5, "n": 10**30}, [1], 3, "s", {}]
    got = [r[0] for r in spark.createDataFrame([(k, json.dumps(t)) for k, t in enumerate(texts)], "k int, p string").orderBy("k").select(shapes.shape(F.col("p"))).collect()]
    assert [shapes.paths(s) for s in got] == [
        {"a": "str", "b": "int", "k": "object", "k.Q": "bool", "k.b": "array", "k.c": "float", "k.z": "null"},
        {"a b": "object", "a b.`q": "int", "a b.x,y": "float", "a b.é<>": "object", "e": "int", "n": "int"},
        {"": "array"},
        {"": "int"},
        {"": "str"},
        {},
    ]


def test_nested_drift(spark):
    bar = {"e": "kline", "E": 2, "s": "x", "k": {"t": 1, "T": 2, "c": "5", "o": "5", "h": "5", "l": "5", "q": "7"}}
    turned = {"k": dict(reversed(bar["k"].items())), "s": "y", "E": 3, "e": "kline"}
    number = {**bar, "k": {**bar["k"], "c": 5.25}}
    more = {**bar, "k": {**bar["k"], "new": {"deep": 1}}}
    less = {"e": "kline", "k": {"t": 1}}
    hidden = {**bar, "_seen": {"at": 1}}
    rows = [json.dumps(m) for m in (bar, turned, number, more, less, hidden)] + ['{"e":"kline","odd":1}', '{"e":"other","x":1}', "no json", None, '{"e":"kline","E":1,"E":2}']
    opened = normalize.open_envelope(spark.createDataFrame([(k, p, "r") for k, p in enumerate(rows)], "n int, payload string, shape string"))
    got = {r.n: r for r in shapes.nested_drift(opened).collect()}
    assert len(got) == len(rows) and got[0].shape == "r"
    assert [got[k].drifted for k in range(len(rows))] == [False, False, True, True, False, False, False, False, False, False, False]
    assert got[0].shape_hash == got[1].shape_hash == got[5].shape_hash != got[2].shape_hash
    assert list(got[2].mismatched) == ["k.c"] and list(got[3].unexpected) == ["k.new", "k.new.deep"]
    assert list(got[6].unexpected) == ["odd"] and "k.c" in got[4].missing and got[8].shape_hash is None
    assert shapes.nested_drift(opened.limit(0)).count() == 0


def run(spark, tmp_path, batches, **options):
    """Feed micro-batches of (id, cursor, second, recovered) through the reorder buffer; rows by batch."""
    spark.conf.set(*reorder.PROVIDER)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    source = tmp_path / "in"
    schema = "id string, cursor bigint, event_us bigint, arrival_seq bigint, fetched boolean, event_ts timestamp"
    for k, rows in enumerate(batches):
        frame = spark.createDataFrame([(i, c, s * 1_000_000, 100 * k + n, f) for n, (i, c, s, f) in enumerate(rows)], "id string, cursor bigint, event_us bigint, arrival_seq bigint, fetched boolean")
        frame.withColumn("event_ts", F.timestamp_micros("event_us")).coalesce(1).write.parquet(str(source / f"b={k:02d}"))
    out = []

    def keep(df, number):
        out.append([(r.id, r.cursor, r.recovered, r.lost) for r in df.collect()])

    stream = spark.readStream.schema(schema + ", b int").option("maxFilesPerTrigger", 1).parquet(str(source)).drop("b")
    both = reorder.recovered_stream(stream.where("not fetched").drop("fetched"), stream.where("fetched").drop("fetched"), ["id"], "event_ts", **options)
    query = both.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return out


def test_rows_behind_a_gap_wait_and_come_out_in_order(spark, tmp_path):
    batches = [
        [("a", 1, 1, False), ("a", 2, 2, False), ("a", 5, 5, False), ("a", 6, 6, False), ("b", 7, 5, False), ("b", None, 1, False)],
        [("a", 4, 4, True), ("a", 3, 3, True), ("a", 2, 2, True), ("b", 8, 6, False)],
        [("a", 9, 9, False), ("a", 9, 9, True), ("a", 12, 12, False), ("a", 13, 13, False)],
        [("b", 9, 100, False)],
        [("b", 10, 101, False)],
        [("a", 8, 8, True), ("a", 14, 102, False), ("b", 11, 200, False)],
        [("b", 12, 201, False)],
    ]
    # Two files for each batch may be read in one turn by the two halves of the union; what matters is each key's order.
    got = [r for rows in run(spark, tmp_path, batches, patience_seconds=30) for r in rows]
    a = [r[1:] for r in got if r[0] == "a"]
    assert a == [(1, False, 0), (2, False, 0), (3, True, 0), (4, True, 0), (5, False, 0), (6, False, 0), (9, False, 2), (12, False, 2), (13, False, 0), (14, False, 0)]
    assert [r[1] for r in got if r[0] == "b" and r[1] is not None] == [7, 8, 9, 10, 11, 12]
    assert [r for r in got if r[1] is None] == [("b", None, False, 0)]
