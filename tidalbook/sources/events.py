"""Adapters from raw tables to the canonical event table, and generated events.

Canonical columns: symbol, event_ts, available_ts, event_us and available_us
(epoch microseconds, for arithmetic), price, size, source, arrival_seq. Every
operator that speaks of input order orders by arrival_seq, as Spark has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def micros(ts: Column) -> Column:
    """Epoch microseconds of a timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as canonical events: one symbol per user, available k seconds late."""
    raw = read_table(spark, sf_dir, "events")
    late = F.get_json_object("props", "$.k").cast("int")
    return raw.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("ts").alias("event_ts"),
        (F.col("ts") + F.make_dt_interval(secs=F.coalesce(late, F.lit(0)).cast("decimal(18,6)"))).alias("available_ts"),
        micros(F.col("ts")).alias("event_us"),
        (micros(F.col("ts")) + F.coalesce(late, F.lit(0)) * 1_000_000).alias("available_us"),
        F.col("value").alias("price"),
        F.lit(1.0).alias("size"),
        F.lit("trade").alias("source"),
        F.col("event_id").alias("arrival_seq"),
        F.col("event_type").alias("kind"),
    )


def with_time_defaults(events: DataFrame) -> DataFrame:
    """Fill the chain published, available, processed, observation from what is given.

    explicit_availability is true where published, available or processed was given.
    """
    given = F.col("published_ts").isNotNull() | F.col("available_ts").isNotNull() | F.col("processed_ts").isNotNull()
    published = F.coalesce("published_ts", "event_ts")
    available = F.coalesce(F.col("available_ts"), published)
    processed = F.coalesce(F.col("processed_ts"), available)
    return events.withColumn("explicit_availability", given).withColumns(
        {"published_ts": published, "available_ts": available, "processed_ts": processed, "observation_ts": F.coalesce("observation_ts", "event_ts")}
    )


def synthetic_trades(spark: SparkSession, n: int, symbol: str = "BTCUSDT", start_us: int = 1_700_000_000_000_000) -> DataFrame:
    """n trades, one a second: price gains 0.1 * i, size .01 + .001 * i."""
    i = F.col("id").cast("double")
    return spark.range(n).select(
        F.lit(symbol).alias("symbol"),
        F.timestamp_micros(F.lit(start_us) + F.col("id") * 1_000_000).alias("event_ts"),
        (F.lit(100.0) + 0.1 * i * (i + 1) / 2).alias("price"),
        (F.lit(0.01) + 0.001 * i).alias("size"),
        F.lit("trade").alias("source"),
        F.col("id").alias("arrival_seq"),
    )
