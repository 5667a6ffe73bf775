"""Mixing sources to target weights along a curriculum that changes over time.

Each source has a schedule: its weight as a function of training time, linear
between knots from time 0 to time 1. The integral of a schedule is the source's
weight in the whole mix. Targets share all words by these weights; a target
stops at ``repeats`` times its source's words and the excess is shared again by
weight until none is above, which is the same as one level for all:
min(weight * level, repeats * size).

A source's documents stand in one fixed order, by a digest of id and text, and
are gone through again and again until the target is filled; the copy in which
that happens is cut there, so that the words taken are the target, rounded.
The word at offset x of a source is wanted at the time at which the integral of
the schedule reaches the share x / target of its total: the cumulative demand
is inverted, segment by segment, and gives each copy its position. The mix is
all copies, sorted by position over ranges.

Cases: a null text has no words, and a document without words is never taken; a
null source is one source, the last; a null doc_id is an id like any other;
rows that repeat are rows of their own; an empty table gives an empty table;
other columns are ignored, or carried along where asked for.

How it scales
-------------
Texts are read once, for their words and digest. Sources are summed up by a
partial aggregate and levelled by aggregates over the table of sources, of
which only sums reach the driver. Running sums go by (source, slice of the
digests), a slice of about SLICE_ROWS documents, so a source with most
documents is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalbook.llm._shared import stored
from tidalbook.llm.ordering import checked, numbered

#: Knots of (time, weight), the first at time 0 and the last at time 1.
Schedule = Sequence[tuple[float, float]]

REPEATS = 3
SLICE_ROWS = 1 << 12
WORD = r"[^\x20\x09-\x0D]++"


def integral(schedule: Schedule) -> float:
    """The weight of a schedule over the whole of training; an error where it is none."""
    times = [t for t, _ in schedule]
    if times[:1] != [0] or times[-1:] != [1] or any(b <= a for a, b in pairwise(times)) or any(w < 0 for _, w in schedule):
        raise ValueError(f"not a schedule from time 0 to 1 with weights of 0 or more: {schedule!r}")
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in pairwise(schedule))


def time_of(share: Column, schedule: Schedule) -> Column:
    """The time at which the integral of ``schedule`` reaches ``share`` (0 to 1) of its total."""
    area = share * F.lit(float(integral(schedule)))
    out, done = F.lit(1.0), integral(schedule)
    for (t0, w0), (t1, w1) in reversed(list(pairwise(schedule))):
        done -= (t1 - t0) * (w0 + w1) / 2
        left = F.greatest(area - F.lit(float(done)), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(float(w0 * w0)) + F.lit(2.0 * (w1 - w0) / (t1 - t0)) * left, F.lit(0.0)))
        at = F.least(F.lit(float(t0)) + F.when(left > 0, F.lit(2.0) * left / (F.lit(float(w0)) + root)).otherwise(0.0), F.lit(float(t1)))
        out = at if (t1, w1) == tuple(schedule[-1]) else F.when(area < F.lit(float(done + (t1 - t0) * (w0 + w1) / 2)), at).otherwise(out)
    return out


def sized(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(row_id, doc_id, source, size, digest, at, carried columns), written: words of each document and its place in the order."""
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    out = docs.select("doc_id", "source", size.alias("size"), digest.alias("digest"), *[F.col(c).alias(f"carried_{c}") for c in carry])
    out = out.withColumn("at", F.conv(F.substring("digest", 1, 15), 16, 10).cast("bigint"))
    return stored(out.withColumn("row_id", F.monotonically_increasing_id()), "mix-sizes")


def targets(sizes: DataFrame, schedules: Sequence[Schedule], repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, n_rows, source_no, kind, target, quota), written: what each source gives to the mix.

    Sources by code point, null last, get the schedules in turn; quota is the
    target in whole words.
    """
    weights = [integral(s) for s in schedules]
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    sources = numbered(totals, [], [F.col("source").asc_nulls_last()], "source_no").withColumn("kind", (F.col("source_no") % len(schedules)).cast("int"))
    of_kind = F.element_at(F.array(*[F.lit(w).cast("decimal(20,6)") for w in weights]), F.col("kind") + 1)
    sources = stored(sources.withColumn("weight", of_kind).withColumn("most", F.col("source_size") * repeats), "mix-sources")
    weight, most = F.col("weight").cast("double"), F.col("most").cast("double")
    level, closed = 0.0, -1
    while True:  # each turn closes a source or is the last; what comes to the driver is four sums
        full = most <= weight * F.lit(level)
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("most"))).alias("given"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count(F.when(full, 1)).alias("closed"),
        ).first()
        if row["closed"] == closed:
            break
        level = (float(row["all"] or 0) - float(row["given"] or 0)) / float(row["open"]) if row["open"] else float("inf")
        closed = row["closed"]
    target = F.least(F.when(F.col("weight") > 0, weight * F.lit(level)).otherwise(0.0), most)
    return stored(sources.withColumn("target", target).withColumn("quota", F.floor(F.col("target") + 0.5)).drop("weight", "most"), "mix-targets")


def mixed(sizes: DataFrame, sources: DataFrame, schedules: Sequence[Schedule]) -> DataFrame:
    """(row_id, doc_id, source, epoch, words, position, carried columns): the copies that the mix takes, sorted by position over ranges.

    position is the time from 0 to 1; words is under the document's size where
    the target is filled within it. Copies of equal position go by source, then
    by epoch and digest.
    """
    named = sources.select(F.col("source").alias("its_source"), "source_size", "source_no", "n_rows", "kind", "quota")
    rows = sizes.where("size > 0").join(checked(named), F.col("source").eqNullSafe(F.col("its_source")))
    slices = F.ceil(F.col("n_rows") / SLICE_ROWS)
    rows = rows.withColumn("slice", F.least(F.floor(F.col("at") / F.lit(float(1 << 60)) * slices), slices - 1))
    sums = rows.groupBy("source_no", "slice").agg(F.sum("size").alias("in_slice"))
    earlier = Window.partitionBy("source_no").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # a row for each slice
    sums = stored(sums.select("source_no", "slice", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)).alias("slices_before")), "mix-slices")
    inside = Window.partitionBy("source_no", "slice").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("rows_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(checked(sums), ["source_no", "slice"])
    placed = placed.withColumn("start", F.col("slices_before") + F.col("rows_before"))
    epochs = F.expr("sequence(0L, (quota - start - 1) div source_size)")
    copies = placed.where("start < quota").withColumn("epoch", F.explode(epochs)).withColumn("start", F.col("start") + F.col("epoch") * F.col("source_size"))
    share = F.col("start") / F.col("quota")
    position = F.coalesce(*[F.when(F.col("kind") == k, time_of(share, s)) for k, s in enumerate(schedules)])
    out = copies.withColumns({"position": position, "words": F.least(F.col("size"), F.col("quota") - F.col("start"))})
    order = ["position", "source_no", "epoch", "digest", "row_id"]
    carried = [c for c in sizes.columns if c.startswith("carried_")]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).select("row_id", "doc_id", "source", "epoch", "words", "position", *carried)


def mix(docs: DataFrame, schedules: Sequence[Schedule], repeats: int = REPEATS, carry: Sequence[str] = ()) -> DataFrame:
    """The training order of ``docs``: mixed(), with columns of ``docs`` (such as text) carried along as carried_<name>."""
    sizes = sized(docs, carry)
    return mixed(sizes, targets(sizes, schedules, repeats), schedules)


def mix_report(docs: DataFrame, schedules: Sequence[Schedule], repeats: int = REPEATS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, position) for each row of ``docs``: words that the mix takes, and the time of the first copy."""
    sizes = sized(docs)
    sources = targets(sizes, schedules, repeats)
    order = stored(mixed(sizes, sources, schedules), "mix")
    taken = order.groupBy(F.col("row_id").alias("taken_id")).agg(F.sum("words").alias("words"), F.min("position").alias("position"))
    named = sources.select(F.col("source").alias("its_source"), "source_size", "target")
    out = sizes.join(checked(named), F.col("source").eqNullSafe(F.col("its_source"))).join(taken, F.col("row_id") == F.col("taken_id"), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken"), "position")
