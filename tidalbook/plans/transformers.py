"""Named changes to a vector's values, applied in the order asked for."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Transformer = Callable[[Column], Column]
_known: dict[str, Transformer] = {
    "clip_non_finite": lambda v: F.map_filter(v, lambda _, x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
    "scale_price_2x": lambda v: F.transform_values(v, lambda k, x: F.when(k == "price", x * 2.0).otherwise(x)),
    "drop_window_max": lambda v: F.map_filter(v, lambda k, _: k != "window_max"),
}


def register_transformer(name: str, change: Transformer) -> None:
    """Use ``change``, from a map of values to such a map, under this name."""
    _known[name] = change


def transformed(vectors: DataFrame, names: Sequence[str], column: str = "values") -> DataFrame:
    """``vectors`` after the named changes; an unknown name is an error. A null map stays null, an empty one empty."""
    out = F.col(column)
    for name in names:
        if name not in _known:
            raise ValueError(f"no transformer is registered as {name!r}")
        out = _known[name](out)
    return vectors.withColumn(column, out)


def as_json(vectors: DataFrame, column: str = "values") -> DataFrame:
    """Add ``payload``: all columns as one JSON object, times in ISO form, absent ones left out."""
    return vectors.withColumn("payload", F.to_json(F.struct(*[F.col(c) for c in vectors.columns])))


def from_json(payloads: DataFrame, schema: str) -> DataFrame:
    """Vectors of JSON objects in the column ``payload``; what no JSON object is gives a row of nulls."""
    return payloads.select(F.from_json("payload", schema).alias("v")).select("v.*")
