"""Gap recovery in a stream: rows behind a gap wait for what is fetched, then come out in order.

A key's rows carry a cursor that counts up by one. The state of a key is the
cursor that comes next and the rows that wait, by cursor. Rows that continue the
sequence leave at once. Behind a gap they wait until recovered rows close it, or
until the watermark has passed the first waiting row's time and the patience;
then the gap is given up and the sequence goes on behind it. Live and recovered
rows go through the same state, so a cursor leaves once, whichever came first.

Rows without a cursor are in no sequence and leave at once. A cursor below the
next one was sent or given up before and is left out. Of equal cursors of one
micro-batch a live row goes before a recovered one, then the earlier arrival.
Rows without a time wait as if theirs were the watermark. Null keys are a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidalbook.operators.scan import fresh

#: Spark keeps this state in RocksDB: lists and maps by key with timers need it.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Reorder(StatefulProcessor):
    """Emits each key's rows in the order of their cursors, with ``lost``: how many cursors before the row were given up."""

    def __init__(self, schema: T.StructType, cursor: str, time: str, order: str, recovered: str, patience_ms: int, first: int | None, lost: str) -> None:
        self.told = Row(*schema.names, lost)
        self.schema, self.cursor, self.time, self.order, self.recovered, self.patience, self.first = schema, cursor, time, order, recovered, patience_ms, first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "cursor bigint")
        self.due = handle.getValueState("due", "at_ms bigint")
        self.waiting = handle.getMapState("waiting", T.StructType([T.StructField("cursor", T.LongType())]), self.schema)

    def _told(self, row: tuple, lost: int) -> Row:
        return self.told(*row, lost)

    def _set_timer(self, at_ms: int | None) -> None:
        """At most one timer a key."""
        set_to = self.due.get()[0] if self.due.exists() else None
        if set_to == at_ms:
            return
        if set_to is not None:
            self.handle.deleteTimer(set_to)
            self.due.clear()
        if at_ms is not None:
            self.handle.registerTimer(at_ms)
            self.due.update((at_ms,))

    def _released(self, rows: dict[int, tuple], start: int, lost: int) -> tuple[list[Row], int]:
        """Rows from cursor ``start`` on as far as they follow each other, and the cursor after them."""
        out = []
        while start in rows:
            out.append(self._told(rows.pop(start), lost))
            start, lost = start + 1, 0
        return out, start

    def _wait(self, rows: dict[int, tuple], now_ms: int) -> None:
        """Give the rows that wait a timer by the first of them."""
        if not rows:
            self._set_timer(None)
            return
        at = rows[min(rows)][self.schema.names.index(self.time)]
        self._set_timer(max((now_ms if at is None else at // 1000) + self.patience, now_ms + 1))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        batch = sorted(rows, key=lambda r: (r[self.cursor] is not None, r[self.cursor] or 0, bool(r[self.recovered]), r[self.order] is None, r[self.order] or 0))
        for row in batch:
            if row[self.cursor] is None:
                yield self._told(tuple(row), 0)
        placed = [r for r in batch if r[self.cursor] is not None]
        if not placed:
            return
        begin = self.next.get()[0] if self.next.exists() else (placed[0][self.cursor] if self.first is None else self.first)
        held = {k[0]: v for k, v in self.waiting.iterator()} if self.due.exists() else {}
        known = set(held)
        for row in placed:
            if row[self.cursor] >= begin:
                held.setdefault(row[self.cursor], tuple(row))
        out, after = self._released(held, begin, 0)
        yield from out
        self._store(held, known, after, timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.due.clear()
        held = {k[0]: v for k, v in self.waiting.iterator()}
        known = set(held)
        if held:
            begin, low = self.next.get()[0], min(held)
            out, after = self._released(held, low, low - begin)
            yield from out
            self._store(held, known, after, timerValues)

    def _store(self, held: dict[int, tuple], known: set[int], after: int, timers: Any) -> None:
        self.next.update((after,))
        for gone in known - set(held):
            self.waiting.removeKey((gone,))
        for new in set(held) - known:
            self.waiting.updateValue((new,), held[new])
        self._wait(held, max(timers.getCurrentWatermarkInMs(), 0))

    def close(self) -> None:
        pass


def recovered_stream(live: DataFrame, fetched: DataFrame, keys: list[str], watermark: str, delay: str = "0 seconds", cursor: str = "cursor", time: str = "event_us", order: str = "arrival_seq", patience_seconds: float = 60.0, first: int | None = None) -> DataFrame:
    """Live rows and those fetched after gaps, each cursor of a key once and in order, with ``recovered`` and ``lost``.

    ``watermark`` is the event-time column (a timestamp) and ``delay`` its
    allowed lateness; ``time`` is the same time in microseconds. A key begins at
    ``first``, or at the smallest cursor of its first micro-batch. The stream
    needs the state store of ``PROVIDER``.
    """
    recovered, lost = fresh(live.columns, "recovered", "lost")
    both = live.withColumn(recovered, F.lit(False)).unionByName(fetched.withColumn(recovered, F.lit(True)), allowMissingColumns=True).withWatermark(watermark, delay)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in both.schema.fields])
    work = Reorder(schema, cursor, time, order, recovered, int(patience_seconds * 1000), first, lost)
    return both.groupBy(*keys).transformWithState(work, T.StructType([*schema.fields, T.StructField(lost, T.LongType())]), "Append", "EventTime")
