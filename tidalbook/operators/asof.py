"""As-of joins and point-in-time reads."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidalbook.operators.scan import fresh, last_before, range_of, spread


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_us: str,
    right_us: str,
    tie: Sequence[str] = (),
    alias: str = "right",
    allow_exact: bool = True,
    tolerance_us: int | None = None,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` at or before it, as a struct ``alias``.

    Both sides are put in one table and scanned in order of (time, side, tie),
    so one shuffle is enough and ties go to the right row that is last in
    ``tie``. Rows without a match, or with one older than ``tolerance_us``,
    get null. ``allow_exact=False`` takes only earlier rows. ``bucket_seconds``
    cuts hot keys into time buckets (see ``operators.scan``).
    """
    payload = F.struct(*[F.col(c) for c in right.columns])
    tagged = right.select(*keys, F.col(right_us).alias("_us"), F.lit(0 if allow_exact else 2).alias("_side"), F.struct(*[F.col(t) for t in tie] or [F.lit(0)]).alias("_tie"), payload.alias("_right"))
    rows = left.select(*keys, F.col(left_us).alias("_us"), F.lit(1).alias("_side"), F.struct("*").alias("_left"))
    both = tagged.unionByName(rows, allowMissingColumns=True)
    found = last_before(both, keys, ["_us", "_side", "_tie"], F.col("_right"), "_match", bucket_seconds * 1_000_000 if bucket_seconds else None)
    out = found.where(F.col("_side") == 1)
    if tolerance_us is not None:
        out = out.withColumn("_match", F.when(F.col("_us") - F.col(f"_match.{right_us}") <= tolerance_us, F.col("_match")))
    return out.select("_left.*", F.col("_match").alias(alias))


def enrich(left: DataFrame, auxiliary: dict[str, DataFrame], keys: dict[str, Sequence[str]], required: Sequence[str] = (), bucket_seconds: int | None = None) -> DataFrame:
    """As-of enrichment by available time, one alias after another.

    For each alias the columns ``<alias>_present``, ``<alias>_price`` and
    ``<alias>_available_us`` are added, and ``cutoff_us`` rises to the matched
    row's available time. An alias without declared keys joins by symbol; a
    required alias that is missing is an error.
    """
    missing = [a for a in required if a not in auxiliary]
    if missing:
        raise ValueError(f"required auxiliary inputs are missing: {missing}")
    out = left.withColumn("cutoff_us", F.col("available_us"))
    for alias, table in auxiliary.items():
        by = list(keys.get(alias, ["symbol"]))
        right = table.select(*by, *[c for c in ("available_us", "event_us", "price") if c not in by])
        joined = asof_join(out, right, by, "available_us", "available_us", ("event_us",), "_aux", bucket_seconds=bucket_seconds)
        out = joined.withColumns(
            {
                f"{alias}_present": F.col("_aux").isNotNull(),
                f"{alias}_price": F.col("_aux.price"),
                f"{alias}_available_us": F.col("_aux.available_us"),
                "cutoff_us": F.greatest("cutoff_us", "_aux.available_us"),
            }
        ).drop("_aux")
    return out


def point_in_time(vectors: DataFrame, keys: Sequence[str], decision_us: int, tie: str = "arrival_seq") -> DataFrame:
    """For each key the latest vector that was available and had happened by ``decision_us``.

    A partial aggregate: only one row per task and key is shuffled.
    """
    seen = vectors.where((F.col("available_us") <= decision_us) & (F.col("event_us") <= decision_us))
    rest = [c for c in vectors.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct("event_us", "available_us", tie))
    return seen.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")


def latest(vectors: DataFrame, keys: Sequence[str], by: Sequence[str] = ("arrival_seq",)) -> DataFrame:
    """For each key the row that arrived last, or the last in another order."""
    rest = [c for c in vectors.columns if c not in keys]
    return vectors.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_row")).select(*keys, "_row.*")


def latest_servable(vectors: DataFrame, keys: Sequence[str], decision_us: int) -> DataFrame:
    """The latest row of each key if it is servable at ``decision_us``; history is no fallback."""
    return latest(vectors, keys).where((F.col("available_us") <= decision_us) & (F.col("event_us") <= decision_us))


def recent(vectors: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """For each key its n newest rows by (event, available) time.

    Spark applies the limit on the row number in every task before the shuffle
    (WindowGroupLimit), so a hot key sends n rows from each task.
    """
    order = [F.desc("event_us"), F.desc("available_us"), F.desc("arrival_seq")]
    return vectors.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def in_range(vectors: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """Rows whose event time lies in the range, both ends included."""
    return vectors.where(F.col("event_us").between(start_us, end_us))


def retained(history: DataFrame, keys: Sequence[str], now_us: int, ttl_us: int, keep: int) -> DataFrame:
    """What retention keeps: rows available within the time to live, and of those the newest ``keep`` of a key."""
    alive = history.where(F.col("available_us") >= now_us - ttl_us)
    return recent(alive, keys, keep).drop("rank")


def cached_lookup(puts: DataFrame, asks: DataFrame, keys: Sequence[str], time: str, at: str, capacity: int, arrival: str = "arrival_seq", alias: str = "found", tolerance_us: int | None = None) -> DataFrame:
    """Each row of ``asks`` with what a cache of ``capacity`` times a key would give it, as a struct ``alias``.

    Rows of both tables are taken in the order of ``arrival``, puts first. A put
    sets its time's row; beyond the capacity the smallest time goes. An ask gets
    the row of the largest time that the cache holds then and that is not after
    ``at``, or null where there is none, or it is older than ``tolerance_us``.
    Null keys are a key; puts without a time and asks without ``at`` find and
    are found by nothing; of puts of equal arrival and time any one is taken.

    A key with very many rows is cut into ranges of arrivals by counts. What the
    cache holds before a range is the newest times of all ranges before: each
    range gives its own ``capacity`` newest, and these, MOST_RANGES times
    ``capacity`` rows a key at most, are folded from range to range.
    """
    side, order, when, part, row, ask, *own = fresh([*puts.columns, *asks.columns, alias], "side", "order", "when", "part", "put_row", "ask_row", *[f"key{k}" for k in range(len(keys))])
    named = [F.col(k).alias(o) for k, o in zip(keys, own, strict=True)]
    put = puts.where(F.col(time).isNotNull()).select(*named, F.lit(1).alias(side), F.col(arrival).alias(order), F.col(time).cast("bigint").alias(when), F.struct("*").alias(row))
    asked = asks.select(*named, F.lit(2).alias(side), F.col(arrival).alias(order), F.col(at).cast("bigint").alias(when), F.struct("*").alias(ask))
    both = put.unionByName(asked, allowMissingColumns=True)
    bounds = spread(both, own, [order])
    both = both.withColumn(part, F.lit(0) if bounds is None else F.coalesce(range_of(F.col(order), bounds), F.lit(-1)))
    if bounds is not None:
        newest = both.where(F.col(side) == 1).groupBy(*own, part, when).agg(F.max_by(row, order).alias(row))
        newest = newest.withColumn(side, F.row_number().over(Window.partitionBy(*own, part).orderBy(F.desc(when)))).where(F.col(side) <= capacity)
        marks = both.where(F.col(side) == 2).select(*own, part).distinct()
        folded = newest.unionByName(marks, allowMissingColumns=True).select(*own, part, when, row)

        def fold(rows: pd.DataFrame) -> pd.DataFrame:
            held: dict[int, object] = {}
            out = []
            for number, group in rows.sort_values(part, kind="stable").groupby(part, sort=True):
                if group[when].isna().any():
                    out += [(*rows[own].iloc[0], number, t, r) for t, r in held.items()]
                for t, r in zip(group[when], group[row], strict=True):
                    if not pd.isna(t):
                        held[int(t)] = r
                held = dict(sorted(held.items())[-capacity:])
            return pd.DataFrame(out, columns=[*own, part, when, row])

        before = folded.groupBy(*own).applyInPandas(fold, folded.schema)
        both = both.unionByName(before.withColumn(side, F.lit(0)), allowMissingColumns=True)

    schema = T.StructType([*asks.schema.fields, T.StructField(alias, T.StructType(puts.schema.fields))])
    target = to_arrow_schema(schema)
    by = [*own, part]
    places = [both.columns.index(c) for c in (*by, side, when, row, ask)]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = None
        times: list[int] = []
        held: dict[int, object] = {}
        for batch in batches:
            columns = [batch.column(p).to_pylist() for p in places]
            out, found = [], []
            for *key, kind, t, told, asking in zip(*columns, strict=True):
                if key != current:
                    current, times, held = key, [], {}
                if kind < 2:
                    if t not in held:
                        insort(times, t)
                    held[t] = told
                    if len(times) > capacity:
                        del held[times.pop(0)]
                    continue
                place = bisect_right(times, t) if t is not None else 0
                near = times[place - 1] if place else None
                out.append(asking)
                found.append(held[near] if near is not None and (tolerance_us is None or t - near <= tolerance_us) else None)
            if out:
                rows = pa.array(out, pa.struct(list(target)[:-1]))
                yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.array(found, target.field(len(target) - 1).type)], schema=target)

    return both.repartition(*by).sortWithinPartitions(*by, F.when(F.col(side) > 0, F.col(order)).asc_nulls_first(), side, when).mapInArrow(look, schema)
