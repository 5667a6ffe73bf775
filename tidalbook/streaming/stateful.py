"""Keyed streaming operators: dedup with a sliding time to live, late rows, features.

State is per key in Spark's state store and survives restarts with the query's
checkpoint. Rows of a micro-batch are taken in arrival order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Before any time.
NEVER = -(2**62)

Update = Callable[[tuple[Any, ...], Iterable[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]


def _in_order(frames: Iterable[pd.DataFrame], order: str) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)


def has_watermark(events: DataFrame) -> bool:
    """Whether a node of the plan sets a watermark, whatever columns are called."""
    plan = events._jdf.queryExecution().analyzed().treeString()
    return re.search(r"^[ :+\-]*EventTimeWatermark ", plan, re.MULTILINE) is not None


def stream_dedup(events: DataFrame, key: str, time: str = "event_us", ttl_us: int = 300_000_000, order: str = "arrival_seq") -> DataFrame:
    """Rows whose key was not seen within the time to live; each sighting, kept or not, renews it.

    The state of a key is one number. With a watermark on ``events`` it goes
    once the watermark is past the last sighting and the time to live; without
    one it stays. Rows without a time are kept and renew nothing. Rows without a
    key are kept: they are no sighting of anything.
    """
    expires = events.isStreaming and has_watermark(events)

    def update(_: tuple[Any, ...], frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = _in_order(frames, order)
        known = rows[time].notna().to_numpy()
        at = rows.loc[known, time].to_numpy(dtype=np.int64)
        first = state.get[0] if state.exists and state.get[0] is not None else NEVER
        high = np.maximum.accumulate(np.append(first, at))
        keep = ~known
        keep[known] = (high[:-1] == NEVER) | (at - high[:-1] > ttl_us)
        last = int(high[-1])
        if last != NEVER:
            state.update((last,))
            if expires:
                state.setTimeoutTimestamp(max((last + ttl_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield rows[keep]

    timeout = GroupStateTimeout.EventTimeTimeout if expires else GroupStateTimeout.NoTimeout
    keyed = events.where(F.col(key).isNotNull()).groupBy(key).applyInPandasWithState(update, events.schema, "seen bigint", "append", timeout)
    return keyed.unionByName(events.where(F.col(key).isNull()))


def stream_late(events: DataFrame, keys: list[str], time: str = "event_us", policy: str = "accept", order: str = "arrival_seq") -> DataFrame:
    """Rows with watermark_us and late against the largest time of their key so far."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields) + ", watermark_us bigint, late boolean"

    def update(_: tuple[Any, ...], frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        high = state.get[0] if state.exists else None
        rows, marks, late = _in_order(frames, order), [], []
        for at in rows[time]:
            marks.append(high)
            late.append(high is not None and at < high)
            high = int(at) if high is None else max(high, int(at))
        state.update((high,))
        out = rows.assign(watermark_us=pd.array(marks, dtype="Int64"), late=late)
        yield out[~out["late"]] if policy == "drop" else out

    return events.groupBy(*keys).applyInPandasWithState(update, fields, "high bigint", "append", GroupStateTimeout.NoTimeout)


def stream_features(events: DataFrame, keys: list[str], windows: tuple[int, ...] = (3, 5), order: str = "arrival_seq") -> DataFrame:
    """Price, log return and for each window mean, maximum, minimum and exponential mean, incrementally.

    The state of a key is its last prices (as many as the longest window), the
    last positive price, a row count and one number per exponential mean.
    """
    longest = max(windows)
    names = [f"{what}_{w}" for w in windows for what in ("sma", "max", "min", "ema")]
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields)
    schema = base + ", ret_1 double, " + ", ".join(f"{n} double" for n in names)

    def update(_: tuple[Any, ...], frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import math

        prices, positive, count, emas = (list(state.get[0]), state.get[1], state.get[2], list(state.get[3])) if state.exists else ([], None, 0, [0.0] * len(windows))
        rows = _in_order(frames, order)
        rows = rows[rows["price"].map(lambda p: p is not None and math.isfinite(p))].reset_index(drop=True)
        out: dict[str, list[float | None]] = {n: [] for n in ("ret_1", *names)}
        for price in rows["price"]:
            out["ret_1"].append(math.log(price / positive) if positive and price > 0 else None)
            prices, count = [*prices, float(price)][-longest:], count + 1
            for k, w in enumerate(windows):
                full = count >= w
                recent = prices[-w:]
                if full:
                    emas[k] = float(price) if count == w else 2.0 / (w + 1) * price + (1 - 2.0 / (w + 1)) * emas[k]
                for what, value in (("sma", sum(recent) / len(recent)), ("max", max(recent)), ("min", min(recent)), ("ema", emas[k])):
                    out[f"{what}_{w}"].append(value if full else None)
            positive = float(price) if price > 0 else positive
        state.update((prices, positive, count, emas))
        yield rows.assign(**{n: pd.array(v, dtype="Float64") for n, v in out.items()})

    return events.groupBy(*keys).applyInPandasWithState(update, schema, "prices array<double>, positive double, seen bigint, emas array<double>", "append", GroupStateTimeout.NoTimeout)


def mirrored(batch: Callable[[DataFrame, int], None], other: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that gives each micro-batch to two sinks."""

    def write(df: DataFrame, number: int) -> None:
        df.persist()
        try:
            batch(df, number)
            other(df, number)
        finally:
            df.unpersist()

    return write


def recomputed(journal: DataFrame, keys: list[str], late_keys: DataFrame) -> DataFrame:
    """Journal rows of the keys that late rows touched, in event order, to compute anew."""
    return journal.join(late_keys.select(*keys).distinct(), keys, "left_semi").orderBy(*keys, "available_us", "event_us", "arrival_seq")


def capped(df: DataFrame, limit: int, policy: str = "drop_newest", order: str = "arrival_seq") -> DataFrame:
    """A micro-batch cut to ``limit`` rows, as lossy back-pressure policies ask for it."""
    if policy not in ("drop_newest", "drop_oldest"):
        raise ValueError(f"unknown policy {policy!r}")
    return df.orderBy(F.asc(order) if policy == "drop_newest" else F.desc(order)).limit(limit)
