"""From features to positions: signals, risk, fills, portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalbook.functions.scalars import signal


def signals(features: DataFrame, price: str = "price", average: str = "sma_3", fallback: str | None = None, ret: str = "ret_1") -> DataFrame:
    """Add side, signal_size and confidence; rows without an average or a return get none.

    size is the return's amount, at most 1; confidence is the same for a trade
    and 0 for flat.
    """
    mean = F.coalesce(F.col(average), F.col(fallback)) if fallback else F.col(average)
    strength = F.least(F.abs(F.col(ret)), F.lit(1.0))
    side = signal(F.col(price), mean, F.col(ret))
    ready = features.where(mean.isNotNull() & F.col(ret).isNotNull())
    return ready.withColumn("side", side).withColumn("signal_size", F.when(F.col("side") == "flat", 0.0).otherwise(strength)).withColumn("confidence", F.when(F.col("side") == "flat", 0.0).otherwise(strength))


def risk(proposed: DataFrame, max_notional: float, max_symbols: int) -> DataFrame:
    """Order intents: the ``max_symbols`` most confident symbols, each by its first sizeable signal.

    proposed: symbol, side, signal_size, confidence, price, ord. Flat signals
    and those without a positive price or size are passed over; quantity is
    the size, at most what max_notional buys. The final top is a bounded sort.
    """
    fit = proposed.where((F.col("side") != "flat") & (F.col("price") > 0) & (F.col("signal_size") > 0))
    first = fit.groupBy("symbol").agg(F.max_by(F.struct("side", "signal_size", "price", "confidence", "ord"), F.struct(F.col("confidence"), -F.col("ord"))).alias("s")).select("symbol", "s.*")
    top = first.orderBy(F.desc("confidence"), F.asc("ord")).limit(max_symbols)
    return top.withColumn("quantity", F.least(F.col("signal_size"), F.lit(max_notional) / F.col("price")))


def last_prices(events: DataFrame) -> DataFrame:
    """(symbol, price): the last to arrive for each symbol."""
    return events.groupBy("symbol").agg(F.max_by("price", "arrival_seq").alias("price"))


def fills(orders: DataFrame, prices: DataFrame) -> DataFrame:
    """Orders with fill_price and status: filled, or rejected where no price is known."""
    known = prices.select("symbol", F.col("price").alias("fill_price"))
    out = orders.join(known, "symbol", "left")
    return out.withColumn("status", F.when(F.col("fill_price").isNull(), "rejected").otherwise("filled"))


def portfolio(filled: DataFrame, cash: float) -> tuple[DataFrame, DataFrame]:
    """(symbol, position) and one row (cash, symbols): filled orders folded; cash is not under zero."""
    done = filled.where("status = 'filled'")
    sign = F.when(F.col("side") == "sell", -1.0).otherwise(1.0)
    positions = done.groupBy("symbol").agg(F.sum(sign * F.col("quantity")).alias("position"))
    spent = F.coalesce(F.sum(sign * F.col("quantity") * F.col("fill_price")), F.lit(0.0))
    return positions, done.agg(F.greatest(F.lit(0.0), F.lit(cash) - spent).alias("cash"), F.countDistinct("symbol").alias("symbols"))


def decision_audit(features: DataFrame, proposed: DataFrame, by: list[str]) -> DataFrame:
    """Features and the signals that came of them, row by row."""
    return features.join(proposed, by, "left")
