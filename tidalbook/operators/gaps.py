"""Gaps, late rows, missing dates and recovery windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.operators.scan import AUTO, Width, carry, fresh, last_before, spread

#: The first cursor in milliseconds that can be a time: 2000-01-01.
FIRST_MS = 946_684_800_000
_NONE = "none"


def detect_gaps(events: DataFrame, keys: Sequence[str], lag_seconds: float, order: Sequence[str] = ("arrival_seq",), cadence: Column | None = None, recovery: bool = False, width: Width = AUTO) -> DataFrame:
    """Add mode, missing, gap_seconds, strong and irreparable to each row.

    Sequence: a numeric ``cursor`` (null where the feed has none) that leaves
    out numbers. Bar: with ``cadence`` in seconds, a millisecond ``bar_cursor``
    that is further on than cadence and lag; bars so placed get no weak check.
    Weak: the event time is more than the lag after the largest before.
    """
    has_bars = cadence is not None and "bar_cursor" in events.columns
    cursor_before, bar, bar_before, high = fresh([*events.columns, "cursor", "mode"], "cursor_before", "bar", "bar_before", "time_before")
    out = events if "cursor" in events.columns else events.withColumn("cursor", F.lit(None).cast("bigint"))
    out = out.withColumn(bar, F.when(F.col("bar_cursor") >= FIRST_MS, F.col("bar_cursor")) if has_bars else F.lit(None).cast("bigint"))
    before = {cursor_before: ("last", F.col("cursor"), False), bar_before: ("last", F.col(bar), False), high: ("max", F.col("event_us"), False)}
    out = carry(out, keys, order, before, spread(events, keys, order, width))
    missing = F.col("cursor") - F.col(cursor_before) - 1
    strong = F.coalesce(missing > 0, F.lit(False))
    step = F.greatest((F.col(bar) - F.col(bar_before)) / 1000.0, F.lit(0.0))
    every = cadence if cadence is not None else F.lit(None).cast("double")
    is_bar = step.isNotNull() & F.coalesce(every > 0, F.lit(False))
    far = F.coalesce(is_bar & (step > every + lag_seconds), F.lit(False))
    gap = F.greatest((F.col("event_us") - F.col(high)) / 1e6, F.lit(0.0))
    weak = F.coalesce(gap > lag_seconds, F.lit(False))
    mode = F.when(strong, "sequence_gap_detection").when(far, "bar_cursor_gap_detection").when(is_bar, _NONE).when(weak, "weak_gap_detection").otherwise(_NONE)
    out = out.withColumn("mode", mode)
    return out.withColumns(
        {
            "missing": F.when(F.col("mode") == "sequence_gap_detection", missing).when(F.col("mode") == "bar_cursor_gap_detection", F.greatest(F.bround(step / every).cast("bigint") - 1, F.lit(0))).otherwise(0).cast("bigint"),
            "gap_seconds": F.when(F.col("mode") == "bar_cursor_gap_detection", step).when(F.col("mode") == "weak_gap_detection", gap).otherwise(0.0),
            "strong": F.col("mode").isin("sequence_gap_detection", "bar_cursor_gap_detection"),
            "irreparable": F.col("mode").isin("sequence_gap_detection", "bar_cursor_gap_detection") & F.lit(not recovery),
        }
    ).drop(cursor_before, bar, bar_before, high)


def late_rows(events: DataFrame, keys: Sequence[str], time: str = "event_us", order: Sequence[str] = ("arrival_seq",), policy: str = "accept", width: Width = AUTO) -> DataFrame:
    """Add watermark_us, late and lateness_us against the largest time of earlier rows.

    policy: ``accept`` keeps late rows marked, ``drop`` leaves them out,
    ``fail`` raises at run time. The watermark closes nothing.
    """
    out = carry(events, keys, order, {"watermark_us": ("max", F.col(time), False)}, spread(events, keys, order, width))
    return _late_marked(out, time, policy)


def _late_marked(out: DataFrame, time: str, policy: str) -> DataFrame:
    late = F.coalesce(F.col(time) < F.col("watermark_us"), F.lit(False))
    out = out.withColumns({"late": late, "lateness_us": F.when(late, F.col("watermark_us") - F.col(time)).otherwise(0)})
    if policy == "drop":
        return out.where(~F.col("late"))
    if policy == "fail":
        return out.where(F.when(F.col("late"), F.raise_error(F.lit("late event"))).otherwise(F.lit(True)).cast("boolean"))
    if policy != "accept":
        raise ValueError(f"unknown late policy {policy!r}")
    return out


def cumulative_lateness(events: DataFrame, keys: Sequence[str], order: Sequence[str] = ("arrival_seq",), width: Width = AUTO) -> DataFrame:
    """Running count of late rows, running largest lateness and running largest step in time per key."""
    (last,) = fresh([*events.columns, "watermark_us", "late", "lateness_us"], "time_before")
    width = spread(events, keys, order, width)
    before = {"watermark_us": ("max", F.col("event_us"), False), last: ("last", F.col("event_us"), False)}
    marked = _late_marked(carry(events, keys, order, before, width), "event_us", "accept")
    step = F.greatest(F.col("event_us") - F.col(last), F.lit(0))
    sums = {"late_so_far": ("sum", F.col("late").cast("bigint"), True), "worst_so_far": ("max", F.col("lateness_us"), True), "longest_gap_us": ("max", step, True)}
    return carry(marked, keys, order, sums, width).drop(last)


def watermark_reject(events: DataFrame, keys: Sequence[str], width: Width = AUTO) -> DataFrame:
    """Rows not available before an earlier accepted row of their key.

    An accepted row is a running maximum, so the largest of all earlier rows
    is the largest accepted one.
    """
    return late_rows(events, keys, "available_us", policy="drop", width=width).drop("watermark_us", "late", "lateness_us")


def bar_gap_count(bars: DataFrame, keys: Sequence[str], interval_us: int, order: Sequence[str] = ("event_us", "arrival_seq")) -> DataFrame:
    """Per key the number of neighbouring bars further apart than the interval."""
    (before,) = fresh(bars.columns, "bar_before")
    rows = last_before(bars, keys, order, F.col("event_us"), before, spread(bars, keys, order))
    return rows.groupBy(*keys).agg(F.count_if(F.coalesce(F.col("event_us") - F.col(before) > interval_us, F.lit(False))).alias("gaps"))


def missing_dates(rows: DataFrame, keys: Sequence[str], day: Column) -> DataFrame:
    """(keys, day): days between a key's first and last that it has no row on."""
    days = rows.select(*keys, day.alias("day")).where("day is not null").distinct()
    first, last = fresh([*keys, "day"], "first_day", "last_day")
    span = days.groupBy(*keys).agg(F.min("day").alias(first), F.max("day").alias(last))
    calendar = span.select(*keys, F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("day"))
    return calendar.join(days, [*keys, "day"], "left_anti")


def fill_plan(missing: DataFrame, unhealthy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What to fetch again: missing days and days of poor quality, each once."""
    return missing.select(*keys, "day").unionByName(unhealthy.select(*keys, "day")).dropDuplicates([*keys, "day"])


def verify_window(actual: DataFrame, cursor: str, first: int, last: int, step: int, only_above: bool = False) -> DataFrame:
    """(problem, cursor, n): what a recovered window lacks or has too much of.

    problem is ``missing`` (expected, not there), ``unexpected`` (there, not
    expected; with ``only_above`` only beyond the window's end) or ``duplicate``
    (there n times). No rows mean that the recovery is exact.
    """
    spark = actual.sparkSession
    expected = spark.range(first, last + 1, step).withColumnRenamed("id", "_expected")
    have = actual.groupBy(F.col(cursor).alias("cursor")).agg(F.count("*").alias("n"))
    missing = expected.join(have, F.col("_expected") == F.col("cursor"), "left_anti").select(F.lit("missing").alias("problem"), F.col("_expected").alias("cursor"), F.lit(0).cast("bigint").alias("n"))
    beyond = F.col("cursor") > last if only_above else (F.col("cursor") < first) | (F.col("cursor") > last) | ((F.col("cursor") - first) % step != 0)
    unexpected = have.where(beyond).select(F.lit("unexpected").alias("problem"), "cursor", "n")
    repeated = have.where("n > 1").select(F.lit("duplicate").alias("problem"), "cursor", "n")
    return missing.unionByName(unexpected).unionByName(repeated)
