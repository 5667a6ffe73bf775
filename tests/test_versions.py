"""The version gate, both layouts, and manifests of landed files."""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidalbook.sources import files, lake, versions


def put(at, version, normalizer=None, **columns):
    told = {b"schema_version": version.encode()} if version else {}
    told |= {b"normalizer_version": normalizer.encode()} if normalizer else {}
    at.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns).replace_schema_metadata(told), at)


def part(base, env, symbol, day, dataset="trades"):
    return base / dataset / f"env={env}" / "venue=BINANCE" / f"symbol={symbol}" / f"date={day}"


def test_gate_names_the_file(spark, tmp_path):
    put(tmp_path / "a" / "good.parquet", "v2", x=[1])
    assert versions.read_gated(spark, f"file://{tmp_path}/a").first().normalizer_version == versions.DEFAULT
    put(tmp_path / "a" / "odd one.parquet", "v9", x=[2])
    with pytest.raises(versions.VersionError, match="unsupported schema_version: v9 in .*odd%20one.parquet$"):
        versions.read_gated(spark, f"file://{tmp_path}/a")
    put(tmp_path / "a" / "none.parquet", None, x=[2])
    (tmp_path / "a" / "text.parquet").write_text("no parquet")
    with pytest.raises(versions.VersionError, match="schema_version missing in .*none.parquet and 2 other files"):
        versions.read_gated(spark, f"file://{tmp_path}/a")
    reasons = {r.file.rsplit("/", 1)[1]: r.reason for r in versions.refused(files.footers(spark, f"file://{tmp_path}/a")).collect()}
    assert set(reasons) == {"odd%20one.parquet", "none.parquet", "text.parquet"} and reasons["text.parquet"].startswith("unreadable")


def test_columns_that_came_later(spark, tmp_path):
    put(tmp_path / "1.parquet", "v1", x=[1])
    put(tmp_path / "2.parquet", "v2", "n7", x=[2])
    put(tmp_path / "3.parquet", "v3", x=[3], raw_run_id=["r"], in_file=["mine"])
    put(tmp_path / "4.parquet", "v3", "n9", x=[4, 5], normalizer_version=["own", None])
    rows = {r.x: r for r in versions.read_gated(spark, f"file://{tmp_path}").collect()}
    assert {x: r.normalizer_version for x, r in rows.items()} == {1: None, 2: "n7", 3: versions.DEFAULT, 4: "own", 5: None}
    assert rows[3].raw_run_id == "r" and rows[3].in_file == "mine" and set(versions.ADDED) <= set(rows[1].asDict())
    old = versions.read_gated(spark, f"file://{tmp_path}/1.parquet")
    assert old.columns == ["x"]


def test_spark_stamps_what_it_writes(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    versions.stamped(spark.range(3).withColumn("p", F.col("id") % 2), "v3", "n1").write.partitionBy("p").parquet(at)
    assert {(r.version, r.normalizer_version) for r in files.footers(spark, at).collect()} == {("v3", "n1")}
    assert sorted((r.id, r.p, r.normalizer_version) for r in versions.read_gated(spark, at).collect()) == [(0, 0, "n1"), (1, 1, "n1"), (2, 0, "n1")]


def test_older_layout_only_where_the_newer_has_nothing(spark, tmp_path):
    base = f"file://{tmp_path}"
    with pytest.raises(FileNotFoundError):
        versions.read_layouts(spark, base, "trades", "prod")
    for symbol, day, x in (("007", "2024-01-01", 1), ("007", "2024-01-02", 2)):
        put(tmp_path / "prod" / f"symbol={symbol}" / f"date={day}" / "data.parquet", "v1", x=[x])
    only_old = versions.read_layouts(spark, base, "trades", "prod")
    assert sorted((r.x, r.symbol, r.env, r.venue, str(r.date)) for r in only_old.collect()) == [(1, "007", "prod", "BINANCE", "2024-01-01"), (2, "007", "prod", "BINANCE", "2024-01-02")]
    put(part(tmp_path, "prod", "007", "2024-01-02") / "part.parquet", "v2", x=[20], more=["m"])
    put(part(tmp_path, "other", "X", "2024-01-02") / "part.parquet", "v8", x=[30])  # not of this env: not looked at
    assert [(r.x, r.symbol) for r in versions.read_layouts(spark, base, "trades", "prod").collect()] == [(20, "007")]
    both = versions.read_layouts(spark, base, "trades", "prod", by_partition=True)
    assert sorted((r.x, r.more, r.normalizer_version) for r in both.collect()) == [(1, None, None), (20, "m", versions.DEFAULT)]
    assert versions.read_layouts(spark, base, "none", "prod").count() == 2


def test_manifest_of_landed_files(spark, tmp_path):
    lines = [{"run_id": "b", "exchange_ts": None}, {"run_id": "b", "exchange_ts": "2024-01-02T00:00:00Z"}, {"run_id": "", "exchange_ts": "2024-01-05T00:00:00Z"}, {"run_id": "a", "exchange_ts": "2024-01-01T00:00:00Z"}, {"run_id": None}]
    text = "\n".join(map(json.dumps, lines)) + "\n\nbroken {\n"
    (tmp_path / "a+b c.json").write_text(text)
    (tmp_path / "blank.json").write_text("\n")
    (tmp_path / "empty.json").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # several splits
    try:
        rows = {r.file: r for r in lake.raw_manifest(spark, f"file://{tmp_path}").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(rows) == {"a+b c.json", "blank.json"}  # Spark lists no empty files
    one, none = rows["a+b c.json"], rows["blank.json"]
    assert (one.sha256, one.bytes, one.lines, one.line_count, one.broken_lines) == (hashlib.sha256(text.encode()).hexdigest(), len(text), 7, 5, 1)
    assert one.run_ids == ["a", "b"] and (str(one.first_exchange_ts), str(one.last_exchange_ts)) == ("2024-01-02 00:00:00", "2024-01-01 00:00:00")
    assert (none.line_count, none.broken_lines, none.run_ids, none.first_exchange_ts) == (0, 0, [], None)
