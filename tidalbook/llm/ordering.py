"""Numbering rows in a global order without one task for all of them, and joins with sides of a checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalbook.llm._shared import fresh, stored

#: Rows of a side up to which it is broadcast; a larger one is joined by the shuffle.
SMALL_ROWS = 50_000


def checked(side: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``side``, a stored table of short rows, with a broadcast hint if it has at most ``rows`` of them."""
    return F.broadcast(side) if side.count() <= rows else side


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """``rows`` with ``name``: the row's place, from 0, among those of equal ``keys`` in ``order``.

    Rows are sorted by ranges of keys and order, so a key that holds most rows
    is spread over many tasks; equal rows too, as where they were read breaks
    their ties. Each range counts its rows, the counts of a key (one for each
    range at most) are summed up, and what comes before a range is joined back.
    Null keys are a key. An empty table gives an empty table.
    """
    place, read, part, first, n, before, *own = fresh(rows, "place", "read_at", "part", "first_place", "n_rows", "rows_before", *[f"of_{k}" for k in keys], "of_part")
    by = [*keys, *order]
    ranges = rows.withColumn(read, F.monotonically_increasing_id()).repartitionByRange(*by, read).sortWithinPartitions(*by, read)
    written = stored(ranges.drop(read).withColumn(place, F.monotonically_increasing_id()), "sorted").withColumn(part, F.shiftrightunsigned(place, 33))
    counts = written.groupBy(*keys, part).agg(F.min(place).alias(first), F.count("*").alias(n))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).withColumnsRenamed(dict(zip([*keys, part], own, strict=True))).drop(n)
    offsets = checked(stored(offsets, "sorted-counts"))
    on = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip([*keys, part], own, strict=True)]
    return written.join(offsets, on).withColumn(name, F.col(place) - F.col(first) + F.col(before)).select(*rows.columns, name)
