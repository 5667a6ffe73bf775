"""Compile a feature graph to DataFrame transforms.

Row frames run inside chunks of a key (``operators.scan.in_chunks``), and what
looks back without a bound is carried from range to range of the time, so no key
is one task's work, however many rows it has. Nodes of a level that count the
same rows share one window specification. Absent values are null. All kinds but
``ema`` are built-in expressions; the recurrence of ``ema`` runs in Arrow batches
over the sorted chunks with one running number per window. A chunk takes it up
anew so many rows before its own that what lies further back weighs under
EMA_REST of the mean, which is below the rounding of a double.

``history`` caps what lag, zscore and volatility may look back to: a longer one
never emits. Rolling windows have no cap. Keys may be null; rows without a finite
price are left out; equal orders are taken in any order; repeated rows each
count; an empty table gives an empty table with all columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalbook.operators.scan import AUTO, CHUNK, Running, Width, carry, fresh, in_chunks, spread
from tidalbook.plans.definitions import FeatureSet, Node, stages

HISTORY = 512
EPSILON = 1e-12
EMA_REST = 1e-20
#: Kinds that look back over emitted values.
BY_COUNT = ("lag", "zscore", "volatility")
ORDER = ("available_us", "event_us", "arrival_seq")

Aggregator = Callable[[Column, WindowSpec], Column]
_custom: dict[str, Aggregator] = {}


def register_aggregator(name: str, build: Aggregator) -> None:
    """Add a rolling aggregator: ``build(value, window)`` gives its Column."""
    _custom[name] = build


def finite(value: Column) -> Column:
    """True for numbers that are neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def _rolling(n: Node, value: Column, spec: WindowSpec) -> Column:
    width = int(n.param("window"))
    frame = spec.rowsBetween(-(width - 1), 0)
    what = str(n.param("aggregator"))
    if what in _custom:
        found = _custom[what](value, frame)
    else:
        found = {"sma": F.avg, "max": F.max, "min": F.min}[what](value).over(frame)
    return F.when(F.count(value).over(frame) >= width, found)


def _moments(n: Node, seen: str, by: Sequence[str], value: Column) -> tuple[Column, Column, Column]:
    """Count, mean and population deviation of the ``window`` emitted values before.

    ``seen`` counts the emitted values up to the row; a range over it holds the
    right rows whatever gaps the source has.
    """
    width = int(n.param("window", 5))
    by_count = Window.partitionBy(*by).orderBy(seen)
    now, past = by_count.rangeBetween(-width, -1), by_count.rangeBetween(-(width - 1), 0)
    pick = lambda f: F.when(value.isNotNull(), f(value).over(now)).otherwise(f(value).over(past))
    return pick(F.count), pick(F.avg), pick(F.stddev_pop)


def _emas(df: DataFrame, wanted: list[Node], by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Exponential means, seeded with the price of the window's last row."""
    names, widths = [n.name for n in wanted], [int(n.param("window")) for n in wanted]
    alphas = [2.0 / (w + 1) for w in widths]
    key_places = [df.columns.index(k) for k in by]
    value_place = df.columns.index(wanted[0].inputs[0])
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, count, state = None, 0, [0.0] * len(widths)
        for batch in batches:
            key_columns = [batch.column(p).to_pylist() for p in key_places]
            out: list[list[float | None]] = [[] for _ in widths]
            for key, value in zip(zip(*key_columns, strict=True), batch.column(value_place).to_pylist(), strict=True):
                if key != at:
                    at, count = key, 0
                count += value is not None
                for k, width in enumerate(widths):
                    if value is None or count < width:
                        out[k].append(None)
                        continue
                    state[k] = value if count == width else alphas[k] * value + (1 - alphas[k]) * state[k]
                    out[k].append(state[k])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(o, pa.float64()) for o in out)], names=[*batch.schema.names, *names])

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def _is_ema(n: Node) -> bool:
    return n.kind == "rolling" and n.param("aggregator") == "ema"


def _reach(n: Node) -> int:
    """How many rows back, of those that it counts, a node looks."""
    if _is_ema(n):
        width = int(n.param("window"))
        return width + (math.ceil(math.log(EMA_REST) / math.log(1 - 2.0 / (width + 1))) if width > 1 else 0)
    return int(n.param("window", n.param("periods", 5)) or 5)


def _framed(rows: DataFrame, nodes: list[Node], keys: Sequence[str], order: Sequence[str], number: str, chunk_rows: int) -> DataFrame:
    """``rows`` with the nodes whose frames count the rows that ``number`` counts."""
    source = nodes[0].inputs[0]
    chunk, lent = fresh([*rows.columns, *[n.name for n in nodes]], "chunk", "lent")
    counts = F.lit(True) if any(n.kind == "rolling" and not _is_ema(n) for n in nodes) else F.col(source).isNotNull()
    out = in_chunks(rows, number, counts, max(map(_reach, nodes)), chunk, lent, chunk_rows)
    by = [*keys, chunk]
    spec = Window.partitionBy(*by).orderBy(*order)
    emas = [n for n in nodes if _is_ema(n)]
    for group in sorted({n.inputs[0] for n in emas}):
        out = _emas(out, [n for n in emas if n.inputs[0] == group], by, order)
    columns: dict[str, Column] = {}
    for n in nodes:
        value = F.col(n.inputs[0])
        if n.kind == "lag":
            periods = int(n.param("periods", 1))
            quoted = ", ".join(f"`{k}`" for k in by)
            columns[n.name] = F.expr(f"lag(`{n.inputs[0]}`, {periods}) ignore nulls over (partition by {quoted} order by {', '.join(f'`{o}`' for o in order)})")
        elif n.kind in ("zscore", "volatility"):
            width = int(n.param("window", 5))
            count, mean, deviation = _moments(n, number, by, value)
            enough = (count >= width) & F.lit(width >= 2)
            columns[n.name] = F.when(enough & value.isNotNull() & (deviation > 0), (value - mean) / deviation) if n.kind == "zscore" else F.when(enough, deviation)
        elif not _is_ema(n):
            columns[n.name] = _rolling(n, value, spec)
    out = out.withColumns(columns) if columns else out
    return out.where(~F.col(lent)).drop(chunk, lent)


def compute(events: DataFrame, feature_set: FeatureSet, order: Sequence[str] = ORDER, history: int = HISTORY, width: Width = AUTO, chunk_rows: int = CHUNK) -> DataFrame:
    """``events`` with a column for each feature; null where a feature is absent.

    Rows whose price is not finite are left out before any window. ``width``
    says how keys are cut into ranges (``scan.Width``), ``chunk_rows`` how many
    rows a chunk has; results do not depend on them.
    """
    keys = list(feature_set.keys)
    rows = events.where(finite(F.col("price")))
    width = spread(events, keys, order, width)
    for n in feature_set.nodes:
        if n.kind == "lag" and int(n.param("periods", 1)) < 1:
            raise ValueError("a lag looks back one row at least")
    wide = [n.name for n in feature_set.nodes if n.kind in BY_COUNT and int(n.param("window", n.param("periods", 0)) or 0) > history]
    made = [n.name for n in feature_set.nodes]
    counters: dict[str, str] = {}
    for level in stages([n for n in feature_set.nodes if n.name not in wide]):
        basis: dict[str, list[Node]] = {}
        for n in level:
            if n.kind in (*BY_COUNT, "rolling"):
                of_rows = n.inputs[0] == "price" or (n.kind == "rolling" and not _is_ema(n))
                basis.setdefault("" if of_rows else n.inputs[0], []).append(n)
        returns = {n.name: fresh([*rows.columns, *made], f"before_{n.name}")[0] for n in level if n.kind == "return"}
        carried: Running = {returns[n.name]: ("last", F.when(F.col(n.inputs[0]) > 0, F.col(n.inputs[0])), False) for n in level if n.kind == "return"}
        for source in basis:
            if source not in counters:
                (counters[source],) = fresh([*rows.columns, *made, *carried], f"seen_{source}")
                carried[counters[source]] = ("count", F.col(source) if source else F.lit(1), True)
        if carried:
            rows = carry(rows, keys, order, carried, width)
        for source, nodes in basis.items():
            rows = _framed(rows, nodes, keys, order, counters[source], chunk_rows)
        columns: dict[str, Column] = {}
        for n in level:
            source = F.col(n.inputs[0]) if n.inputs else F.col("price")
            if n.kind == "price" and n.name != "price":
                columns[n.name] = F.col("price")
            elif n.kind == "return":
                before = F.col(returns[n.name])
                columns[n.name] = F.when((source > 0) & before.isNotNull(), F.ln(source / before))
            elif n.kind == "constant":
                columns[n.name] = F.lit(float(n.param("value")))
            elif n.kind == "metadata":
                columns[n.name] = F.expr(f"try_cast(`{n.inputs[0]}` as double)")
            elif n.kind == "difference":
                columns[n.name] = source - F.col(n.inputs[1])
            elif n.kind == "ratio":
                below = F.col(n.inputs[1])
                columns[n.name] = F.when(F.abs(below) > float(n.param("epsilon", EPSILON)), source / below)
            elif n.kind == "clip":
                low, high = n.param("min"), n.param("max")
                clipped = source if low is None else F.greatest(source, F.lit(float(low)))
                clipped = clipped if high is None else F.least(clipped, F.lit(float(high)))
                columns[n.name] = F.when(source.isNotNull(), clipped)
        rows = (rows.withColumns(columns) if columns else rows).drop(*returns.values())
    rows = rows.drop(*counters.values())
    return rows.withColumns({name: F.lit(None).cast("double") for name in wide}) if wide else rows


def as_vectors(features: DataFrame, feature_set: FeatureSet) -> DataFrame:
    """Sparse form: values is a map of the features that are present."""
    names = [n.name for n in feature_set.nodes]
    pairs = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in names]), lambda e: e["value"].isNotNull()))
    return features.select(*feature_set.keys, "event_ts", "available_ts", F.lit(feature_set.name).alias("feature_set_name"), F.lit(feature_set.version).alias("feature_set_version"), pairs.alias("values"))
