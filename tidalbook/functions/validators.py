"""Row validation: payload rules for trades, bars and books; event rules; temporal gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalbook.functions.scalars import reasons

FUTURE_MS = 5 * 60 * 1000


def _absent(*names: str) -> list[tuple[Column, str]]:
    return [(F.col(n).isNull(), f"missing_{n}") for n in names]


def _number(name: str) -> tuple[Column, str]:
    value = F.col(name)
    return (value < 0) | F.isnan(value) | (F.abs(value) == float("inf")), f"bad_{name}"


def _clock(name: str, now_ms: int) -> tuple[Column, str]:
    return (F.col(name) < 0) | (F.col(name) > now_ms + FUTURE_MS), f"bad_{name}"


def trade_reasons(now_ms: int) -> Column:
    """Why a trade payload (event_ms, trade_ms, price, quantity) is refused."""
    return reasons([*_absent("event_ms", "price", "quantity"), _clock("event_ms", now_ms), _number("price"), _number("quantity")])


def bar_reasons(now_ms: int) -> Column:
    """Why a bar payload (open_ms, close_ms, open, high, low, close, volume) is refused.

    Only close and volume must be there; the range is checked where open, high
    and low all are.
    """
    whole = F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull()
    return reasons(
        [
            *_absent("close", "volume"),
            _clock("open_ms", now_ms),
            _clock("close_ms", now_ms),
            *[_number(n) for n in ("open", "high", "low", "close", "volume")],
            (whole & (F.col("high") < F.greatest("open", "close", "low")), "high_not_highest"),
            (whole & (F.col("low") > F.least("open", "close", "high")), "low_not_lowest"),
            (F.col("close_ms") < F.col("open_ms"), "close_before_open"),
        ]
    )


def book_reasons(now_ms: int) -> Column:
    """Why a book payload (update_id, bid, bid_size, ask, ask_size, event_ms) is refused; the time may be absent."""
    return reasons(
        [
            *_absent("update_id", "bid", "bid_size", "ask", "ask_size"),
            _clock("event_ms", now_ms),
            *[_number(n) for n in ("bid", "bid_size", "ask", "ask_size")],
            (F.col("ask") < F.col("bid"), "crossed"),
        ]
    )


def event_reasons(columns: Sequence[str]) -> Column:
    """Why a typed event is refused, by those of the rules whose columns it has.

    Processed before received; a bar that closes before it opens or has no
    interval; numbers that are negative or not finite; a crossed book.
    """
    rules = [
        (("process_us", "receive_us"), F.col("process_us") < F.col("receive_us"), "processed_before_received"),
        (("open_us", "close_us"), F.col("close_us") < F.col("open_us"), "close_before_open"),
        (("interval",), F.coalesce(F.col("interval"), F.lit("")) == "", "missing_interval"),
        (("bid_price", "ask_price"), (F.col("bid_price") > 0) & (F.col("ask_price") > 0) & (F.col("ask_price") < F.col("bid_price")), "crossed"),
        *[((n,), *_number(n)) for n in ("price", "size", "open", "high", "low", "close", "volume", "bid_price", "bid_size", "ask_price", "ask_size")],
    ]
    return reasons([(rule, name) for needs, rule, name in rules if set(needs) <= set(columns)])


def split_valid(df: DataFrame, why: Column) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rows with their reasons)."""
    marked = df.withColumn("reasons", why)
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def strict_temporal(df: DataFrame, strict: bool) -> DataFrame:
    """In strict modes only rows whose availability was given, not derived."""
    return df.where("explicit_availability") if strict else df


def series_flags(df: DataFrame, keys: list[str], order: list[str], value: str, policy: dict[str, float]) -> DataFrame:
    """Add flags: what a feature's series breaks of a policy, row by row.

    Policy entries: min, max, non_zero, max_abs_delta, constant_window,
    variance_window with min_variance, sparsity_window with max_sparse_ratio
    (and sparsity_epsilon), drift_baseline_window and drift_recent_window with
    max_mean_shift. Series are per key; give no key of the entity to share one
    series per feature.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    v = F.col(value)
    frame = lambda n: spec.rowsBetween(-(int(n) - 1), 0)
    full = lambda n, rule: (F.count(v).over(frame(n)) >= int(n)) & rule
    rules: list[tuple[Column, str]] = [(F.isnan(v) | (F.abs(v) == float("inf")), "non_finite")]
    if "min" in policy:
        rules.append((v < policy["min"], "below_min"))
    if "max" in policy:
        rules.append((v > policy["max"], "above_max"))
    if policy.get("non_zero"):
        rules.append((v == 0, "zero_not_allowed"))
    if "max_abs_delta" in policy:
        rules.append((F.abs(v - F.lag(v).over(spec)) > policy["max_abs_delta"], "delta_exceeded"))
    if policy.get("constant_window", 0) > 1:
        n = policy["constant_window"]
        rules.append((full(n, F.max(v).over(frame(n)) == F.min(v).over(frame(n))), "constant_run"))
    if policy.get("variance_window", 0) > 1 and "min_variance" in policy:
        n = policy["variance_window"]
        rules.append((full(n, F.var_pop(v).over(frame(n)) < policy["min_variance"]), "low_variance"))
    if policy.get("sparsity_window", 0) > 1 and "max_sparse_ratio" in policy:
        n = policy["sparsity_window"]
        small = F.avg((F.abs(v) <= policy.get("sparsity_epsilon", 1e-12)).cast("double")).over(frame(n))
        rules.append((full(n, small > policy["max_sparse_ratio"]), "sparse_run"))
    if policy.get("drift_baseline_window", 0) and policy.get("drift_recent_window", 0) and "max_mean_shift" in policy:
        old, new = int(policy["drift_baseline_window"]), int(policy["drift_recent_window"])
        shift = F.abs(F.avg(v).over(frame(new)) - F.avg(v).over(spec.rowsBetween(-(old + new - 1), -new)))
        rules.append((full(old + new, shift > policy["max_mean_shift"]), "drift_shift"))
    return df.withColumn("flags", reasons(rules))
