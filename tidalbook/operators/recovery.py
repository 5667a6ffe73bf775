"""What to fetch after a gap, and how what was fetched joins the stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.operators.dedup import keep_first
from tidalbook.operators.scan import AUTO, Width, fresh, running, spread


def trade_cursor(aggregate_id: Column, trade_id: Column, source_id: Column) -> Column:
    """The first of the three that is a whole number; null if none is."""
    return F.coalesce(*[c.cast("string").try_cast("bigint") for c in (aggregate_id, trade_id, source_id)])


def requests(gapped: DataFrame, keys: Sequence[str], cursor: str = "cursor") -> DataFrame:
    """(keys, first, last, boundary) for each row of ``detect_gaps`` that leaves out cursors: the cursors to fetch before it."""
    lost = gapped.where(F.col("missing") > 0).where("mode = 'sequence_gap_detection'")
    at = F.col(cursor)
    return lost.select(*keys, (at - F.col("missing")).alias("first"), (at - 1).alias("last"), at.alias("boundary"))


def asked_for(recovered: DataFrame, wanted: DataFrame, keys: Sequence[str], cursor: str = "cursor", width: Width = AUTO) -> DataFrame:
    """The recovered rows that some request names: a snapshot may hold more.

    Requests and rows of a key are scanned together in the order of their
    cursors; a row is asked for if the furthest end of the requests that begin
    at or before it reaches it. So a request costs one row however many cursors
    it spans. Rows without a cursor are not asked for; repeated rows all stay.
    """
    place, side, end, reached = fresh(recovered.columns, "at_cursor", "is_row", "request_end", "reached")
    rows = recovered.withColumns({place: F.col(cursor).cast("bigint"), side: F.lit(1), end: F.lit(None).cast("bigint")})
    asks = wanted.select(*keys, F.col("first").cast("bigint").alias(place), F.lit(0).alias(side), F.col("last").cast("bigint").alias(end))
    both = rows.unionByName(asks, allowMissingColumns=True)
    out = running(both, keys, [place, side], "max", F.col(end), reached, spread(both, keys, [place], width))
    return out.where((F.col(side) == 1) & (F.col(place) <= F.col(reached))).select(*recovered.columns)


def merged(events: DataFrame, recovered: DataFrame, keys: Sequence[str], cursor: str = "cursor") -> DataFrame:
    """Events and recovered rows, each key and cursor once; an event goes before a recovered row. Rows without a cursor all stay."""
    (late,) = fresh([*events.columns, *recovered.columns], "recovered_late")
    both = events.withColumn(late, F.lit(0)).unionByName(recovered.withColumn(late, F.lit(1)), allowMissingColumns=True)
    whole = keep_first(both.where(F.col(cursor).isNotNull()), [*keys, cursor], [late])
    return whole.unionByName(both.where(F.col(cursor).isNull())).drop(late)
