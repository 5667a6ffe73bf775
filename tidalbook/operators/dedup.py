"""Event identities and keep-first dedup."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IdentityBuilder = Callable[[DataFrame], Column]
_builders: dict[str, IdentityBuilder] = {}


def register_identity(source: str, build: IdentityBuilder) -> None:
    """Use ``build(df)`` as the identity of rows whose source is ``source``."""
    _builders[source] = build


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def identity(df: DataFrame) -> Column:
    """The native id where the feed gives one (trade, then sequence, then source id), else what the event says.

    Venue, symbol and source are part of it. Metadata entries of the same names
    are looked at before the columns.
    """
    meta = (lambda k: F.element_at("metadata", F.lit(k))) if "metadata" in df.columns else (lambda k: F.lit(None).cast("string"))
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    native = F.coalesce(
        *[F.concat(F.lit(f"{kind}:"), blank(value)) for kind in ("trade_id", "sequence_id", "source_id") for value in (meta(kind), _column(df, kind))]
    )
    venue = F.upper(F.coalesce(_column(df, "venue"), F.lit("")))
    base = F.concat_ws("|", venue, _column(df, "symbol"), _column(df, "source"), native)
    guess = F.concat_ws("|", _column(df, "symbol"), _column(df, "event_us"), _column(df, "price"), _column(df, "size"), _column(df, "source"))
    found = F.when(native.isNotNull(), F.concat(F.lit("native|"), base)).otherwise(F.concat(F.lit("event|"), guess))
    for source, build in _builders.items():
        found = F.when(F.col("source") == source, build(df)).otherwise(found)
    return found


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of rows with equal key the first in ``order``.

    An aggregate with a partial stage: each task sends one row per key, so a
    key that very many rows have does not gather in one task.
    """
    rest = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*key).agg(first).select(*[f"_first.{c}" if c in rest else c for c in df.columns])


def dedup_events(events: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Events without repeated identities; the first by arrival stays."""
    return keep_first(events.withColumn("_identity", identity(events)), ["_identity"], [order]).drop("_identity")


def merge_dedup(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Existing rows, then new rows of unknown key; the first of each key stays."""
    both = existing.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, key, ["_age", *order]).drop("_age")


def unknown_only(new: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows whose key no existing row has."""
    return new.join(existing.select(*key).distinct(), list(key), "left_anti")


def ordered_unique(df: DataFrame, key: str, order: str) -> DataFrame:
    """(key, place): each key once, by its first row; place counts from 1.

    Places are counted per range of the order and added up, not in one window
    over all rows. The ranges' bounds are quantiles, one for each shuffle
    partition, so a row is in the same range whenever it is computed. ``order``
    is a number or a time; rows without one come first.
    """
    first = df.groupBy(key).agg(F.min(order).alias(order))
    parts = int(first.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = first.agg(F.percentile_approx(order, [k / parts for k in range(1, parts)] or [0.5])).first()[0]
    bucket = F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds or [])))), lambda b: b < F.col(order))) if bounds else F.lit(0)
    marked = first.withColumn("_range", bucket)
    own = F.row_number().over(Window.partitionBy("_range").orderBy(order, key))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = marked.groupBy("_range").agg(F.count("*").alias("_size"))
    starts = sizes.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    placed = marked.withColumn("_place", own).join(F.broadcast(starts), F.col("_range") == F.col("_of"))  # one row per range
    return placed.select(key, (F.col("_place") + F.col("_start")).alias("place"))
