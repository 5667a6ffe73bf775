"""Running values and row frames per key that do not put a whole key into one task.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task. Here a
key is cut into ranges of its first order column (a time or an arrival number):
rows are handled by (key, range), each range is summed up in one row, the few
summaries of a key are scanned, and what comes before a range is joined back to
its rows. The results are those of the plain window, as all functions offered
are associative. A key with a third of all rows is spread over its ranges.

Ranges cost a second reading of the rows and a join. ``spread`` looks whether
that is needed: where no key has more than KEY_ROWS rows a plain window does,
and otherwise the ranges are cut by counts, at quantiles of the order over all
rows, so that neither a day with most rows nor sparse numbers make large or
very many ranges.

For frames of a bounded number of rows, ``in_chunks`` cuts a key into chunks of
equally many rows and gives each chunk the last rows of the one before, so that
a window inside a chunk sees all that its frame reaches.

Keys may be null and are then a key of their own. Rows with a null order come
first. Equal orders are taken in any order, as in a plain window. Empty tables
give empty tables. Columns of any name stay: internal names are chosen around
them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[str]
#: Rows of a key that a chunk takes in, without those that it gets from the chunk before.
CHUNK = 1 << 16
#: Rows of the largest key up to which a plain window is used, and rows that a range of all keys takes in.
KEY_ROWS = 1 << 20
MOST_RANGES = 512
#: Let ``spread`` choose.
AUTO = "auto"
#: A number: ranges of that width of the first order column. Numbers in order: the ranges' bounds. None: plain windows.
Width = int | str | Sequence[float] | None
#: name -> (sum, max, min, count or last, value, whether the row itself counts)
Running = dict[str, tuple[str, Column, bool]]

_FOLD = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}
_MERGE = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}


def fresh(columns: Sequence[str], *names: str) -> list[str]:
    """These names, each with underscores added until no column has it."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _joined_back(df: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    own = fresh([*df.columns, *summary.columns], *[f"of_{k}" for k in keys])
    right = summary.withColumnsRenamed(dict(zip(keys, own, strict=True)))
    return df.join(right, [F.col(f"`{k}`").eqNullSafe(F.col(f"`{o}`")) for k, o in zip(keys, own, strict=True)], "left").drop(*own)


def spread(df: DataFrame, keys: Order, order: Order, width: Width = AUTO) -> Width:
    """How to cut the keys of ``df``: ``width`` itself unless it is AUTO, which counts the rows of the keys.

    What comes to the driver is one count, or MOST_RANGES bounds at most.
    """
    if width != AUTO:
        return width
    (n,) = fresh(df.columns, "rows_of_key")
    row = df.groupBy(*keys).agg(F.count("*").alias(n)).agg(F.max(n).alias("most"), F.sum(n).alias("total")).first()
    if (row["most"] or 0) <= KEY_ROWS:
        return None
    parts = min(MOST_RANGES, -(-row["total"] // KEY_ROWS))
    bounds = df.agg(F.percentile_approx(order[0], [k / parts for k in range(1, parts)], 10 * MOST_RANGES)).first()[0]
    return sorted(set(bounds or []))


def range_of(column: Column, width: Width) -> Column:
    """The number of the range that a value is in; null for null."""
    if isinstance(width, int | float):
        return F.floor(column / F.lit(width))
    bounds = F.array(*map(F.lit, width)) if width else F.array().cast("array<double>")
    return F.when(column.isNotNull(), F.size(F.filter(bounds, lambda b: b < column)))


def carry(df: DataFrame, keys: Order, order: Order, values: Running, width: Width = None) -> DataFrame:
    """Add a column for each of ``values``: what it comes to over the key's rows so far.

    ``last`` is the last value that is not null. With a ``width`` (see Width),
    keys are cut into ranges of the first of ``order``, a number; without, plain
    windows are used.
    """
    width = spread(df, keys, order, width)
    fold = lambda what, value: F.last(value, ignorenulls=True) if what == "last" else _FOLD[what](value)
    before = lambda by, own: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    if width is None:
        return df.withColumns({n: fold(what, value).over(before(keys, own)) for n, (what, value, own) in values.items()})
    names = list(values)
    cut, *extra = fresh([*df.columns, *names], "range", *[f"{kind}_{k}" for kind in ("value", "sum", "carried") for k in range(len(names))])
    given, sums, carried = (extra[k * len(names) : (k + 1) * len(names)] for k in range(3))
    by = [*keys, cut]
    marked = df.withColumns({cut: range_of(F.col(order[0]), width), **{g: values[n][1] for g, n in zip(given, names, strict=True)}})
    rows = marked.withColumns({n: fold(values[n][0], F.col(g)).over(before(by, values[n][2])) for g, n in zip(given, names, strict=True)})
    at = F.struct(*order)
    total = lambda what, g: F.max_by(g, F.when(F.col(g).isNotNull(), at)) if what == "last" else _FOLD[what](g)
    summary = marked.groupBy(*by).agg(*[total(values[n][0], g).alias(s) for n, g, s in zip(names, given, sums, strict=True)])
    earlier = Window.partitionBy(*keys).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    merge = lambda what, s: F.last(s, ignorenulls=True) if what == "last" else _MERGE[what](s)
    summary = summary.select(*by, *[merge(values[n][0], s).over(earlier).alias(c) for n, s, c in zip(names, sums, carried, strict=True)])
    out = _joined_back(rows, summary, by)

    def whole(what: str, name: str, kept: str) -> Column:
        own, past = F.col(name), F.col(kept)
        if what in ("sum", "count"):
            return F.coalesce(own + past, own, past)
        return F.coalesce(own, past) if what == "last" else (F.greatest if what == "max" else F.least)(own, past)

    return out.withColumns({n: whole(values[n][0], n, c) for n, c in zip(names, carried, strict=True)}).drop(cut, *given, *carried)


def last_before(df: DataFrame, keys: Order, order: Order, value: Column, name: str, width: Width = None, inclusive: bool = False) -> DataFrame:
    """Add ``name``: the last non-null ``value`` of earlier rows of the key (and this one, if inclusive)."""
    return carry(df, keys, order, {name: ("last", value, inclusive)}, width)


def running(df: DataFrame, keys: Order, order: Order, what: str, value: Column, name: str, width: Width = None, inclusive: bool = True) -> DataFrame:
    """Add ``name``: running ``what`` (sum, max, min or count) of ``value`` over the key's rows so far."""
    return carry(df, keys, order, {name: (what, value, inclusive)}, width)


def positions(df: DataFrame, keys: Order, order: Order, name: str, width: Width = None) -> DataFrame:
    """Add ``name``: the row's number within its key, from 1."""
    return running(df, keys, order, "count", F.lit(1), name, width)


def in_chunks(df: DataFrame, number: str, counts: Column, reach: int, chunk: str, lent: str, size: int = CHUNK) -> DataFrame:
    """Add ``chunk`` and ``lent``: rows by chunks of their key, each with what it needs of the chunk before.

    ``number`` counts the rows of the key, up to this one, for which ``counts``
    is true. A frame over (key, chunk) that reaches back over at most ``reach``
    such rows is complete for the rows that are not ``lent``.
    """
    size = max(size, 4 * reach)
    place = F.greatest(F.col(number) - 1, F.lit(0))
    at = F.floor(place / size)
    own = F.struct(at.alias(chunk), F.lit(False).alias(lent))
    copied = counts & (place % size >= size - reach)
    both = F.when(copied, F.array(own, F.struct((at + 1).alias(chunk), F.lit(True).alias(lent)))).otherwise(F.array(own))
    return df.select("*", F.inline(both))
