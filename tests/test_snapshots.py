"""The snapshot table: compaction without loss, readers, conflicts, crashes and upkeep."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidalbook.sources import events, lake
from tidalbook.sources.snapshots import CommitConflict, SnapshotTable

BY, ORDER = ("symbol", "day"), ("arrival_seq",)
BTC = "part['symbol'] = 'BTC'"


def rows(spark, symbol, first, n=20):
    return spark.range(first, first + n).select(F.lit(symbol).alias("symbol"), F.lit("2024-01-01").cast("date").alias("day"), F.col("id").alias("arrival_seq"), (F.col("id") * 0.5).alias("price"))


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, "file://" + str(tmp_path / "t"), BY, ORDER)


def test_partial_compactions_keep_all_rows(spark, table):
    for symbol in ("BTC", "ETH"):
        for first in (0, 10):
            table.append(rows(spark, symbol, first, 10))
    table.compact(BTC)
    table.append(rows(spark, "BTC", 20))
    assert table.read().count() == 60
    assert [(r.status, r.attempts) for r in table.compact(F.col("part")["symbol"] == "ETH").collect()] == [("compacted", 1)]
    assert table.read().count() == 60
    assert {r.part["symbol"]: r.n_rows for r in table.live().where(f"not ({BTC})").collect()} == {"ETH": 20}
    assert table.read(only=BTC).count() == 40 and table.live().where(BTC).count() == 2
    assert rows_of(table.read().where("symbol = 'BTC'")) == rows_of(rows(spark, "BTC", 0, 40))


def test_compaction_in_place_keeps_what_came_between(spark, tmp_path):
    path = "file://" + str(tmp_path / "lake")
    day = lambda symbol, first: events.synthetic_trades(spark, 20, symbol).withColumns({"event_us": F.unix_micros("event_ts"), "arrival_seq": F.col("arrival_seq") + first})
    for symbol in ("BTC", "ETH"):
        lake.write_segments(lake.with_partitions(day(symbol, 0), "paper"), path)
    lake.compact_in_place(spark, path, F.col("symbol") == "BTC")
    lake.write_segments(lake.with_partitions(day("BTC", 20), "paper"), path)
    lake.compact_in_place(spark, path, F.col("symbol") == "ETH")
    assert lake.read_segments(spark, path).count() == 60
    assert not list(tmp_path.glob("*compacting*"))


def test_a_reader_sees_one_version(spark, table):
    table.append(rows(spark, "BTC", 0))
    table.append(rows(spark, "BTC", 10))
    before = table.read()
    assert before.count() == 40
    report = table.compact(dedup_key=["arrival_seq"], dry_run=True).first()
    assert (report.status, report.files, report.n_rows) == ("planned", 2, 40) and table.version() == 2
    table.compact(dedup_key=["arrival_seq"])
    assert before.count() == 40  # the plan of a reader that was there before still finds its files
    assert table.read().count() == 30 and table.read(upto=2).count() == 40
    assert table.compact().count() == 0
    assert table.vacuum(keep=1) == 0 and table.vacuum() == 2
    assert table.read().count() == 30 and table.vacuum() == 0


def test_two_writers(spark, table, monkeypatch):
    table.append(rows(spark, "BTC", 0))
    table.append(rows(spark, "BTC", 20))
    other = SnapshotTable(spark, table.path, BY, ORDER)
    publish, turns = table._publish, []

    def late(version, entries):
        if not turns:
            turns.append(other.append(rows(spark, "BTC", 40)))
        return publish(version, entries)

    monkeypatch.setattr(table, "_publish", late)
    assert [(r.status, r.attempts) for r in table.compact().collect()] == [("compacted", 1)]
    assert turns == [3] and table.version() == 4 and table.read().count() == 60  # rows that came meanwhile stand beside the compacted ones

    def always(version, entries):
        other.compact(min_files=1)
        return publish(version, entries)

    monkeypatch.setattr(table, "_publish", always)
    assert [(r.status, r.attempts) for r in table.compact(min_files=1, attempts=2).collect()] == [("failed", 2)]
    assert other.read().count() == 60
    with pytest.raises(CommitConflict):
        read = other.version()
        other.compact(min_files=1)
        other.commit([], [r.file for r in other.live(read).collect()], read)


def test_a_crash_before_the_commit_changes_nothing(spark, table, monkeypatch):
    table.append(rows(spark, "BTC", 0))
    table.append(rows(spark, "BTC", 20))
    for step in ("commit", "_publish"):
        with monkeypatch.context() as patch:
            patch.setattr(table, step, lambda *_: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError, match="lost"):
                table.compact()
            with pytest.raises(OSError, match="lost"):
                table.append(rows(spark, "ETH", 0))
    assert table.version() == 2 and rows_of(table.read()) == rows_of(rows(spark, "BTC", 0, 40))
    assert table.vacuum(older_than_us=0) == 0
    assert table.vacuum(older_than_us=4_000_000_000_000_000) == 4
    assert table.compact().first().status == "compacted" and table.read().count() == 40


def test_nulls_and_nothing(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.append(rows(spark, "BTC", 0, 0)) == 0 and table.version() == 0
    odd = rows(spark, "x", 0, 3).withColumns({"symbol": F.lit(None).cast("string"), "day": F.lit(None).cast("date"), "commit_": F.lit("x"), "part": F.lit(1)})
    table.append(odd)
    table.append(odd)
    assert table.candidates().first().files == 2
    table.compact(dedup_key=["arrival_seq"])
    assert rows_of(table.read()) == rows_of(odd)
