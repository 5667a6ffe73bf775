"""Telemetry lands once, and its tables are those of a plain fold of its lines."""

from __future__ import annotations

import json

from tidalbook.streaming import telemetry


def put(base, kind, name, *lines):
    at = base / kind
    at.mkdir(parents=True, exist_ok=True)
    (at / f"{name}.jsonl").write_text("".join((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in lines))


def metric(symbol, **counts):
    return {"venue": "binance", "symbol": symbol, "stream_type": "trade", **counts}


def test_read_model(spark, tmp_path):
    base, log, state = tmp_path / "in", f"file://{tmp_path}/log", f"file://{tmp_path}/state"
    put(base, "ingestion_summary", "1", {"trace_id": "t", "env": "dev", "mode": "live", "result": "ok", "recorded_at": "2024-01-01T00:00:01Z", "stream_metrics": [metric("A", gaps_total=1), metric("B", gaps_total="0"), "odd", {}]}, "", "broken {", "[1]")
    put(base, "ingestion_health", "1", {"trace_id": "t", "recorded_at": "2024-01-01T00:00:02Z", "streams_degraded": ["BINANCE:B:trade", "X:C:book", "two:parts"]}, {"env": "dev", "recorded_at": "2024-01-01T00:00:03Z"})
    put(base, "other", "1", {"trace_id": "t"})
    telemetry.land(spark, f"file://{base}", log, state).awaitTermination()

    def tables():
        found = telemetry.landed(spark, log)
        return [sorted(map(tuple, make(found).collect()), key=str) for make in (telemetry.runs, telemetry.streams, telemetry.alerts, telemetry.checkpoints)]

    found = telemetry.landed(spark, log)
    assert found.count() == 3
    states = {r.scope: (r.status, r.run_id) for r in telemetry.streams(found).collect()}
    assert states == {"BINANCE:A:trade": ("degraded", "t"), "BINANCE:B:trade": ("degraded", "t"), "BINANCE:UNKNOWN:unknown": ("ok", "t"), "X:C:book": ("degraded", "t")}
    runs = {r.run_id: r for r in telemetry.runs(found).collect()}
    assert set(runs) == {"t", "dev:unknown:2024-01-01T00:00:03Z"}
    assert (runs["t"].env, runs["t"].result, runs["t"].updated_at[-3:], runs["t"].last_summary_at[-3:], runs["t"].last_health_at[-3:]) == ("unknown", "ok", "02Z", "01Z", "02Z")
    assert telemetry.alerts(found).count() == 0 and telemetry.checkpoints(found).count() == 0

    before = tables()
    telemetry.land(spark, f"file://{base}", log, state).awaitTermination()
    assert tables() == before
    lines = spark.createDataFrame([(line, "file:/x/ingestion_summary/1.jsonl") for line in (base / "ingestion_summary" / "1.jsonl").read_text().split("\n")] + [(line, "file:/x/ingestion_health.jsonl") for line in (base / "ingestion_health" / "1.jsonl").read_text().split("\n")], "value string, file string")
    telemetry.land_batch(lines, log, 0)  # the batch done over
    assert tables() == before and telemetry.landed(spark, log).count() == 3

    put(base, "ingestion_summary", "2", {"trace_id": "u", "result": "failed", "recorded_at": "2024-01-01T00:00:09Z", "stream_metrics": [metric("B"), metric("C", duplicates_total=2)]})
    alert = {"alert_type": "gap", "severity": "high", "observed": 3, "threshold": 2, "recorded_at": "r"}
    put(base, "operational_alert", "1", alert, dict(reversed(alert.items())), {"recorded_at": "q"})
    put(base, "checkpoint_audit_ref", "1", {"stream_key": "k", "recorded_at": "2024-01-02", "cursor_value": 5}, {"stream_key": "k", "recorded_at": "2024-01-01", "cursor_value": 9}, {"stream_key": "*"}, {"stream_key": ""}, {})
    telemetry.land(spark, f"file://{base}", log, state).awaitTermination()
    found = telemetry.landed(spark, log)
    states = {r.scope: (r.status, r.run_id) for r in telemetry.streams(found).collect()}
    assert states["BINANCE:B:trade"] == ("ok", "u") and states["BINANCE:C:trade"] == ("degraded", "u") and states["X:C:book"] == ("degraded", "t")
    assert sorted((r.alert_type, r.severity, r.observed, r.threshold) for r in telemetry.alerts(found).collect()) == [("gap", "high", 3.0, 2), ("unknown", "warning", 0.0, 0)]
    assert [(r.stream_key, r.cursor_value) for r in telemetry.checkpoints(found).collect()] == [("k", "5")]
    assert [r.scope for r in telemetry.with_status(telemetry.streams(found), symbol="c", text="x:").collect()] == ["X:C:book"]
    assert telemetry.with_status(telemetry.streams(found)).first().scope == "BINANCE:C:trade"
