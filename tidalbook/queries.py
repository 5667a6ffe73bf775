"""Registered queries over the driver's tables, each with the SQL that it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalbook.functions import normalize, scalars, shapes, validators
from tidalbook.operators import anomaly, asof, compare, dedup, gaps, quality, recovery, reports
from tidalbook.plans import features, recompute, trading, transformers
from tidalbook.plans.definitions import FeatureSet, default_set, node
from tidalbook.session import scratch_path
from tidalbook.sources import contracts, feature_store, instruments, lake, quarantine, replay, runs, snapshots, versions
from tidalbook.sources.events import market_events, micros, read_table
from tidalbook.streaming import telemetry

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

EV = """WITH ev AS (
  SELECT 'U' || user_id AS symbol, ts AS event_ts, epoch_us(ts) AS event_us,
         epoch_us(ts) + 1000000 * coalesce(TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT), 0) AS available_us,
         value AS price, CAST(1 AS DOUBLE) AS size, 'trade' AS source, event_id AS arrival_seq, event_type AS kind
  FROM events)"""
W = "PARTITION BY symbol ORDER BY available_us, event_us, arrival_seq"
ID = ("symbol", "arrival_seq")


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def q6(value: Column | str) -> Column:
    """Six decimals, halves up: the same on both engines."""
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value * 1_000_000 + 0.5) / 1_000_000


def s6(value: str) -> str:
    return f"floor(({value}) * 1000000 + 0.5) / 1000000"


def _features(spark: SparkSession, sf_dir: str, *nodes: object) -> DataFrame:
    return features.compute(market_events(spark, sf_dir), FeatureSet("q", "v1", tuple(nodes)))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*ID, *[q6(n).alias(n) for n in names])


RET = f"""CASE WHEN price > 0 THEN ln(price / last_value(CASE WHEN price > 0 THEN price END IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) END"""


def full(agg: str, w: int) -> str:
    frame = f"OVER ({W} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(*) {frame} >= {w} THEN {agg}(price) {frame} END"


@registered(f"{EV} SELECT symbol, arrival_seq, {s6('price')} AS price, {s6(RET)} AS ret_1 FROM ev")
def feat_price_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_features(spark, sf_dir, node("ret_1", "return", "price")), "price", "ret_1")


@registered(f"{EV} SELECT symbol, arrival_seq, {s6(full('avg', 3))} AS sma_3, {s6(full('avg', 20))} AS sma_20 FROM ev")
def feat_sma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_features(spark, sf_dir, *[node(f"sma_{w}", "rolling", "price", window=w, aggregator="sma") for w in (3, 20)]), "sma_3", "sma_20")


@registered(f"{EV} SELECT symbol, arrival_seq, {s6(full('max', 5))} AS max_5, {s6(full('min', 5))} AS min_5 FROM ev")
def feat_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_features(spark, sf_dir, *[node(f"{a}_5", "rolling", "price", window=5, aggregator=a) for a in ("max", "min")]), "max_5", "min_5")


def _ema_sql(w: int) -> str:
    a = 2.0 / (w + 1)
    return f"""{EV}, lists AS (SELECT symbol, arrival_seq, list(price) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l FROM ev)
SELECT symbol, arrival_seq, CASE WHEN len(l) >= {w} THEN {s6(f"list_reduce(l[{w}:], lambda x, y: {a!r} * y + {1 - a!r} * x)")} END AS ema_{w} FROM lists"""


@registered(_ema_sql(3))
def feat_ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_features(spark, sf_dir, node("ema_3", "rolling", "price", window=3, aggregator="ema")), "ema_3")


@registered(f"{EV} SELECT symbol, arrival_seq, lag(price, 1) OVER ({W}) AS lag_1, lag(price, 3) OVER ({W}) AS lag_3 FROM ev")
def feat_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, node("lag_1", "lag", "price"), node("lag_3", "lag", "price", periods=3)).select(*ID, "lag_1", "lag_3")


LONG = "PARTITION BY kind ORDER BY available_us, event_us, arrival_seq ROWS BETWEEN 599 PRECEDING AND CURRENT ROW"


@registered(f"{EV} SELECT symbol, arrival_seq, CASE WHEN count(*) OVER ({LONG}) >= 600 THEN {s6(f'avg(price) OVER ({LONG})')} END AS sma_600, CAST(NULL AS DOUBLE) AS lag_600 FROM ev")
def feat_long_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling windows have no longest width; what looks back over emitted values stops at the history."""
    graph = (node("sma_600", "rolling", "price", window=600, aggregator="sma"), node("lag_600", "lag", "price", periods=600))
    return features.compute(market_events(spark, sf_dir), FeatureSet("long", "v1", graph, keys=("kind",))).select(*ID, q6("sma_600").alias("sma_600"), "lag_600")


PRIOR = f"OVER ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"


@registered(f"""{EV} SELECT symbol, arrival_seq, {s6(f"CASE WHEN count(*) {PRIOR} >= 5 AND stddev_pop(price) {PRIOR} > 0 THEN (price - avg(price) {PRIOR}) / stddev_pop(price) {PRIOR} END")} AS z_5 FROM ev""")
def feat_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_features(spark, sf_dir, node("z_5", "zscore", "price", window=5)), "z_5")


@registered(f"""{EV}, r AS (SELECT *, {RET} AS ret_1 FROM ev),
lists AS (SELECT symbol, arrival_seq, list(ret_1) FILTER (WHERE ret_1 IS NOT NULL) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l FROM r)
SELECT symbol, arrival_seq, CASE WHEN len(l) >= 4 THEN {s6("list_aggregate(l[-4:], 'stddev_pop')")} END AS vol_4 FROM lists""")
def feat_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_features(spark, sf_dir, node("ret_1", "return", "price"), node("vol_4", "volatility", "ret_1", window=4)), "vol_4")


@registered(f"""{EV}, l AS (SELECT *, lag(price) OVER ({W}) AS lag_1 FROM ev)
SELECT symbol, arrival_seq, {s6('price - lag_1')} AS delta, {s6('CASE WHEN abs(lag_1) > 1e-12 THEN price / lag_1 END')} AS rel, {s6('least(greatest(price, 10), 60)')} AS clipped, CAST(2.5 AS DOUBLE) AS fixed FROM l""")
def feat_diff_ratio_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = (
        node("lag_1", "lag", "price"),
        node("delta", "difference", "price", "lag_1"),
        node("rel", "ratio", "price", "lag_1"),
        node("clipped", "clip", "price", min=10, max=60),
        node("fixed", "constant", value=2.5),
    )
    return _features(spark, sf_dir, *graph).select(*ID, *[q6(n).alias(n) for n in ("delta", "rel", "clipped")], "fixed")


def _ema_of(w: int) -> str:
    """The exponential mean over the list l of all prices so far."""
    a = 2.0 / (w + 1)
    return f"CASE WHEN len(l) >= {w} THEN {s6(f'list_reduce(l[{w}:], lambda x, y: {a!r} * y + {1 - a!r} * x)')} END"


@registered(f"""{EV}, lists AS (SELECT *, list(price) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l FROM ev)
SELECT symbol, arrival_seq, {s6(RET)} AS ret_1, {", ".join(f"{s6(full(f, w))} AS {n}_{w}" for w in (3, 5, 10, 20, 50) for n, f in (("sma", "avg"), ("max", "max"), ("min", "min")))},
  {", ".join(f"{_ema_of(w)} AS ema_{w}" for w in (3, 5, 10, 20, 50))} FROM lists""")
def feat_default_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = default_set()
    return _rounded(features.compute(market_events(spark, sf_dir), wide), *[n.name for n in wide.nodes if n.name != "price"])


SIGNAL = f"""{EV}, f AS (SELECT *, {full('avg', 3)} AS sma_3, {RET} AS ret_1 FROM ev),
sig AS (SELECT symbol, arrival_seq, price, ret_1, CASE WHEN price > sma_3 AND ret_1 > 0 THEN 'buy' WHEN price < sma_3 AND ret_1 < 0 THEN 'sell' ELSE 'flat' END AS side
        FROM f WHERE sma_3 IS NOT NULL AND ret_1 IS NOT NULL),
s AS (SELECT *, CASE WHEN side = 'flat' THEN 0 ELSE least(abs(ret_1), 1) END AS signal_size FROM sig)"""


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trading.signals(_features(spark, sf_dir, node("sma_3", "rolling", "price", window=3, aggregator="sma"), node("ret_1", "return", "price")))


@registered(f"{SIGNAL} SELECT symbol, arrival_seq, side, {s6('signal_size')} AS signal_size FROM s")
def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signals(spark, sf_dir).select(*ID, "side", q6("signal_size").alias("signal_size"))


RISK = f"""{SIGNAL}, q AS (SELECT symbol, side, price, arrival_seq AS ord, {s6('signal_size')} AS signal_size FROM s WHERE side <> 'flat' AND price > 0 AND {s6('signal_size')} > 0),
first_ AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY signal_size DESC, ord) AS rn FROM q),
top AS (SELECT * FROM first_ WHERE rn = 1 ORDER BY signal_size DESC, ord LIMIT 5),
orders AS (SELECT symbol, side, signal_size, price, ord, least(signal_size, 20.0 / price) AS quantity FROM top)"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _signals(spark, sf_dir).select("symbol", "side", "price", F.col("arrival_seq").alias("ord"), q6("signal_size").alias("signal_size"))
    return trading.risk(rows.withColumn("confidence", F.col("signal_size")), 20.0, 5)


@registered(f"{RISK} SELECT symbol, side, ord, {s6('quantity')} AS quantity FROM orders")
def risk_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("symbol", "side", "ord", q6("quantity").alias("quantity"))


LAST = "last_ AS (SELECT symbol, arg_max(price, arrival_seq) AS fill_price FROM ev WHERE kind <> 'error' GROUP BY symbol)"


@registered(f"{RISK}, {LAST} SELECT symbol, {s6('quantity')} AS quantity, fill_price, CASE WHEN fill_price IS NULL THEN 'rejected' ELSE 'filled' END AS status FROM orders LEFT JOIN last_ USING (symbol)")
def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = trading.last_prices(market_events(spark, sf_dir).where("kind <> 'error'"))
    return trading.fills(_orders(spark, sf_dir), prices).select("symbol", q6("quantity").alias("quantity"), "fill_price", "status")


@registered(f"""{RISK}, {LAST} SELECT {s6("greatest(0, 10000 - coalesce(sum(CASE side WHEN 'sell' THEN -1 ELSE 1 END * quantity * fill_price), 0))")} AS cash, count(DISTINCT symbol) AS symbols FROM orders JOIN last_ USING (symbol)""")
def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = trading.last_prices(market_events(spark, sf_dir).where("kind <> 'error'"))
    _, cash = trading.portfolio(trading.fills(_orders(spark, sf_dir), prices), 10_000.0)
    return cash.select(q6("cash").alias("cash"), "symbols")


def _order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as decisions: each customer's symbol at a time inside the events' span."""
    base = read_table(spark, sf_dir, "orders")
    first = F.unix_micros(F.lit("2024-01-01").cast("timestamp"))
    return base.select("o_orderkey", F.concat(F.lit("U"), (F.col("o_custkey") % 100).cast("string")).alias("symbol"), (first + (F.col("o_orderkey") * 977 % 2_592_000) * 1_000_000).alias("us"))


TIMES = "o AS (SELECT o_orderkey, 'U' || (o_custkey % 100) AS symbol, epoch_us(TIMESTAMP '2024-01-01') + (o_orderkey * 977 % 2592000) * 1000000 AS us FROM orders)"
RIGHT = "r AS (SELECT symbol, available_us, arg_max(price, arrival_seq) AS price, max(arrival_seq) AS arrival_seq FROM ev GROUP BY ALL)"


@registered(f"{EV}, {TIMES}, {RIGHT} SELECT o.o_orderkey, o.symbol, r.arrival_seq AS matched, r.price AS price FROM o ASOF LEFT JOIN r ON o.symbol = r.symbol AND o.us >= r.available_us")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = market_events(spark, sf_dir).select("symbol", "available_us", "arrival_seq", "price")
    found = asof.asof_join(_order_times(spark, sf_dir), right, ["symbol"], "us", "available_us", ["arrival_seq"], "r", bucket_seconds=86_400)
    return found.select("o_orderkey", "symbol", F.col("r.arrival_seq").alias("matched"), F.col("r.price").alias("price"))


@registered(f"{EV}, {TIMES}, {RIGHT} SELECT o.o_orderkey, CASE WHEN o.us - r.available_us <= 3600000000 THEN r.arrival_seq END AS matched FROM o ASOF LEFT JOIN r ON o.symbol = r.symbol AND o.us > r.available_us")
def asof_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = market_events(spark, sf_dir).select("symbol", "available_us", "arrival_seq", "price")
    found = asof.asof_join(_order_times(spark, sf_dir), right, ["symbol"], "us", "available_us", ["arrival_seq"], "r", allow_exact=False, tolerance_us=3_600_000_000, bucket_seconds=86_400)
    return found.select("o_orderkey", F.col("r.arrival_seq").alias("matched"))


@registered(f"""{EV}, a AS (SELECT symbol, arrival_seq, event_us - 3600000000 AS moment FROM ev WHERE kind = 'click'),
p AS (SELECT a.arrival_seq AS ask, a.moment, e.available_us AS t, e.arrival_seq AS n, dense_rank() OVER (PARTITION BY a.arrival_seq ORDER BY e.available_us DESC) AS age
  FROM a JOIN ev e ON e.symbol = a.symbol AND e.kind <> 'click' AND e.arrival_seq <= a.arrival_seq),
f AS (SELECT ask, arg_max(n, (t, n)) AS matched FROM p WHERE age <= 5 AND t <= moment GROUP BY ask)
SELECT a.symbol, a.arrival_seq, f.matched FROM a LEFT JOIN f ON f.ask = a.arrival_seq""")
def asof_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks ask what the five newest other events of their symbol say of an hour before."""
    ev = market_events(spark, sf_dir).select(*ID, "kind", "event_us", "available_us")
    asks = ev.where("kind = 'click'").select(*ID, (F.col("event_us") - 3_600_000_000).alias("at"))
    found = asof.cached_lookup(ev.where("kind <> 'click'").select(*ID, "available_us"), asks, ["symbol"], "available_us", "at", 5)
    return found.select(*ID, F.col("found.arrival_seq").alias("matched"))


@registered(f"""{EV}, l AS (SELECT * FROM ev WHERE kind = 'click'), r AS (SELECT symbol, available_us, arg_max(price, event_us) AS aux_price FROM ev WHERE kind = 'view' GROUP BY ALL)
SELECT l.symbol, l.arrival_seq, r.aux_price IS NOT NULL AS aux_present, r.aux_price AS aux_price, greatest(l.available_us, coalesce(r.available_us, 0)) AS cutoff_us
FROM l ASOF LEFT JOIN r ON l.symbol = r.symbol AND l.available_us >= r.available_us""")
def asof_aux(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    out = asof.enrich(ev.where("kind = 'click'"), {"aux": ev.where("kind = 'view'")}, {"aux": ["symbol"]}, ["aux"], bucket_seconds=86_400)
    return out.select(*ID, "aux_present", "aux_price", "cutoff_us")


AT = "(SELECT (min(event_us) + max(event_us)) // 2 FROM ev)"


def _middle(ev: DataFrame) -> int:
    low, high = ev.agg(F.min("event_us"), F.max("event_us")).first()
    return 0 if low is None else (low + high) // 2


@registered(f"{EV} SELECT symbol, arg_max(arrival_seq, (event_us, available_us, arrival_seq)) AS arrival_seq, arg_max(price, (event_us, available_us, arrival_seq)) AS price FROM ev WHERE event_us <= {AT} AND available_us <= {AT} GROUP BY symbol")
def pit_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    return asof.point_in_time(ev, ["symbol"], _middle(ev)).select("symbol", "arrival_seq", "price")


@registered(f"{EV}, l AS (SELECT symbol, max(arrival_seq) AS arrival_seq FROM ev GROUP BY symbol) SELECT symbol, arrival_seq, price FROM l JOIN ev USING (symbol, arrival_seq) WHERE available_us <= (SELECT max(event_us) - 3600000000 FROM ev)")
def latest_servable(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    end = ev.agg(F.max("event_us")).first()[0] or 0
    return asof.latest_servable(ev, ["symbol"], end - 3_600_000_000).select("symbol", "arrival_seq", "price")


@registered(f"{EV} SELECT symbol, arrival_seq, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_us DESC, available_us DESC, arrival_seq DESC) AS rn FROM ev) WHERE rn <= 3")
def recent_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.recent(market_events(spark, sf_dir), ["symbol"], 3).select(*ID, "rank")


@registered(f"{EV} SELECT symbol, arrival_seq, price FROM ev WHERE event_us BETWEEN {AT} AND {AT} + 86400000000")
def range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    at = _middle(ev)
    return asof.in_range(ev, at, at + 86_400_000_000).select(*ID, "price")


@registered(f"{EV}, alive AS (SELECT * FROM ev WHERE available_us >= {AT}) SELECT symbol, arrival_seq FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_us DESC, available_us DESC, arrival_seq DESC) AS rn FROM alive) WHERE rn <= 10")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    at = _middle(ev)
    return asof.retained(ev, ["symbol"], at + 1_000_000, 1_000_000, 10).select(*ID)


COPIES = f"""{EV}, twice AS (SELECT * FROM ev UNION ALL SELECT * REPLACE (arrival_seq + 1000000000 AS arrival_seq) FROM ev WHERE arrival_seq % 3 = 0)"""


def _twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    return ev.unionByName(ev.where("arrival_seq % 3 = 0").withColumn("arrival_seq", F.col("arrival_seq") + 1_000_000_000))


@registered(f"{COPIES} SELECT symbol, event_us, min(arrival_seq) AS arrival_seq FROM twice GROUP BY symbol, event_us, price, size, source")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_events(_twice(spark, sf_dir)).select("symbol", "event_us", "arrival_seq")


@registered(f"{EV}, both_ AS (SELECT *, 0 AS age FROM ev WHERE arrival_seq % 2 = 0 UNION ALL SELECT *, 1 FROM ev WHERE arrival_seq % 3 = 0) SELECT symbol, event_us, arg_min(arrival_seq, (age, arrival_seq)) AS arrival_seq FROM both_ GROUP BY symbol, event_us")
def dedup_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    return dedup.merge_dedup(ev.where("arrival_seq % 2 = 0"), ev.where("arrival_seq % 3 = 0"), ["symbol", "event_us"], ["arrival_seq"]).select("symbol", "event_us", "arrival_seq")


@registered(f"{EV} SELECT symbol, arrival_seq FROM ev WHERE arrival_seq % 3 = 0 AND NOT EXISTS (SELECT 1 FROM ev e WHERE e.arrival_seq % 2 = 0 AND e.symbol = ev.symbol AND e.event_us = ev.event_us)")
def dedup_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    return dedup.unknown_only(ev.where("arrival_seq % 3 = 0"), ev.where("arrival_seq % 2 = 0"), ["symbol", "event_us"]).select(*ID)


ARRIVAL = "PARTITION BY symbol ORDER BY arrival_seq"
HIGH = f"max(event_us) OVER ({ARRIVAL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@registered(f"{EV}, g AS (SELECT *, greatest((event_us - {HIGH}) / 1e6, 0) AS gap FROM ev) SELECT symbol, arrival_seq, CASE WHEN gap > 3600 THEN 'weak_gap_detection' ELSE 'none' END AS mode, {s6('CASE WHEN gap > 3600 THEN gap ELSE 0 END')} AS gap_seconds FROM g")
def gaps_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gaps.detect_gaps(market_events(spark, sf_dir), ["symbol"], 3600.0)
    return found.select(*ID, "mode", q6("gap_seconds").alias("gap_seconds"))


@registered("""WITH l AS (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS prev FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 5 <> 0)
SELECT l_orderkey, l_linenumber, CAST(coalesce(CASE WHEN l_linenumber > prev + 1 THEN l_linenumber - prev - 1 END, 0) AS BIGINT) AS missing, coalesce(l_linenumber > prev + 1, false) AS strong FROM l""")
def gaps_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "lineitem").where("(l_orderkey * 7 + l_linenumber) % 5 <> 0")
    rows = rows.select("l_orderkey", "l_linenumber", F.col("l_linenumber").cast("bigint").alias("cursor"), F.lit(0).cast("bigint").alias("event_us"))
    return gaps.detect_gaps(rows, ["l_orderkey"], 1.0, ["l_linenumber"]).select("l_orderkey", "l_linenumber", "missing", "strong")


BARS = f"""{EV}, bars AS (SELECT symbol, event_us // 3600000000 AS hour, min(arrival_seq) AS arrival_seq, arg_min(price, arrival_seq) AS open, max(price) AS high, min(price) AS low, arg_max(price, arrival_seq) AS close, sum(size) AS volume FROM ev GROUP BY ALL)"""


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir).withColumn("hour", F.floor(F.col("event_us") / 3_600_000_000))
    return ev.groupBy("symbol", "hour").agg(
        F.min("arrival_seq").alias("arrival_seq"), F.min_by("price", "arrival_seq").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "arrival_seq").alias("close"), F.sum("size").alias("volume")
    )


@registered(f"{BARS} SELECT symbol, hour, open, high, low, close, volume FROM bars")
def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(spark, sf_dir).select("symbol", "hour", "open", "high", "low", "close", "volume")


@registered(f"{BARS}, d AS (SELECT symbol, hour - lag(hour) OVER (PARTITION BY symbol ORDER BY hour) AS step FROM bars) SELECT symbol, count(*) FILTER (WHERE step > 1) AS gaps FROM d GROUP BY symbol")
def bar_gap_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.bar_gap_count(_bars(spark, sf_dir).withColumn("event_us", F.col("hour") * 3_600_000_000), ["symbol"], 3_600_000_000)


@registered(f"""{BARS}, d AS (SELECT symbol, hour, hour - lag(hour) OVER (PARTITION BY symbol ORDER BY hour) AS step FROM bars)
SELECT symbol, hour, CASE WHEN step * 3600 > 3600 + 60 THEN 'bar_cursor_gap_detection' ELSE 'none' END AS mode, CAST(CASE WHEN step * 3600 > 3600 + 60 THEN step - 1 ELSE 0 END AS BIGINT) AS missing FROM d""")
def gaps_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bars(spark, sf_dir).withColumns({"event_us": F.col("hour") * 3_600_000_000, "bar_cursor": F.col("hour") * 3_600_000})
    return gaps.detect_gaps(rows, ["symbol"], 60.0, ["hour"], F.lit(3600.0)).select("symbol", "hour", "mode", "missing")


@registered(f"""{EV}, d AS (SELECT DISTINCT symbol, CAST(event_ts AS DATE) AS day FROM ev WHERE arrival_seq % 4 = 0), span AS (SELECT symbol, min(day) AS a, max(day) AS z FROM d GROUP BY symbol),
cal AS (SELECT symbol, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM span) SELECT symbol, strftime(day, '%Y-%m-%d') AS day FROM cal ANTI JOIN d USING (symbol, day)""")
def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gaps.missing_dates(market_events(spark, sf_dir).where("arrival_seq % 4 = 0"), ["symbol"], F.to_date("event_ts"))
    return found.select("symbol", F.date_format("day", "yyyy-MM-dd").alias("day"))


RECOVERED = "(SELECT CASE WHEN event_id % 97 = 5 THEN event_id - 1 ELSE event_id END AS cursor FROM events WHERE event_id % 50 <> 7)"


@registered(f"""WITH have AS (SELECT cursor, count(*) AS n FROM {RECOVERED} GROUP BY cursor), want AS (SELECT unnest(generate_series(100, 900)) AS cursor)
SELECT 'missing' AS problem, cursor, 0 AS n FROM want ANTI JOIN have USING (cursor)
UNION ALL SELECT 'unexpected', cursor, n FROM have WHERE cursor > 900 UNION ALL SELECT 'duplicate', cursor, n FROM have WHERE n > 1""")
def recovery_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").where("event_id % 50 <> 7").select(F.when(F.col("event_id") % 97 == 5, F.col("event_id") - 1).otherwise(F.col("event_id")).alias("cursor"))
    return gaps.verify_window(rows, "cursor", 100, 900, 1, only_above=True)


JUMP = "CASE WHEN prev <> 0 THEN abs(price - prev) / abs(prev) END"


@registered(f"{EV}, p AS (SELECT *, lag(price) OVER ({ARRIVAL}) AS prev FROM ev), j AS (SELECT *, {JUMP} AS jump FROM p) SELECT symbol, arrival_seq, {s6('jump')} AS jump, CASE WHEN jump >= 0.6 THEN 'fail' WHEN jump >= 0.35 THEN 'quarantine' WHEN jump >= 0.2 THEN 'warn' END AS jump_tier FROM j")
def anomaly_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.mark_anomalies(market_events(spark, sf_dir), ["symbol"])
    return found.select(*ID, q6("jump").alias("jump"), "jump_tier")


@registered("""WITH p AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity AS size, lag(l_extendedprice) OVER w AS pp, lag(l_quantity) OVER w AS ps FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, l_quantity)),
j AS (SELECT *, CASE WHEN pp <> 0 THEN abs(price - pp) / abs(pp) END AS jump, CASE WHEN ps <> 0 AND size <> 0 THEN abs(size) / abs(ps) END AS spike FROM p),
t AS (SELECT *, CASE WHEN jump >= 0.5 THEN 3 WHEN jump >= 0.3 THEN 2 WHEN jump >= 0.15 THEN 1 ELSE 0 END AS a, CASE WHEN spike >= 20 THEN 3 WHEN spike >= 10 THEN 2 WHEN spike >= 4 THEN 1 ELSE 0 END AS b FROM j)
SELECT l_orderkey, l_linenumber, CASE WHEN a = 0 AND b = 0 THEN NULL WHEN a >= b THEN 'price_jump:' || ['warn', 'quarantine', 'fail'][a] ELSE 'volume_spike:' || ['warn', 'quarantine', 'fail'][b] END AS dominant, CASE b WHEN 0 THEN NULL ELSE ['warn', 'quarantine', 'fail'][b] END AS spike_tier FROM t""")
def anomaly_dominant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("size"), F.lit("kline").alias("source"))
    return anomaly.mark_anomalies(rows, ["l_orderkey"], ["l_linenumber", "price", "size"]).select("l_orderkey", "l_linenumber", "dominant", "spike_tier")


@registered(f"""WITH RECURSIVE {EV.removeprefix('WITH ')}, n AS (SELECT *, row_number() OVER ({ARRIVAL}) AS rn FROM ev),
walk AS (
  SELECT symbol, arrival_seq, rn, price AS ref, 'accept' AS decision FROM n WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.arrival_seq, n.rn, CASE WHEN w.ref IS NOT NULL AND w.ref <> 0 AND abs(n.price - w.ref) / abs(w.ref) >= 0.35 THEN w.ref ELSE n.price END,
         CASE WHEN w.ref = 0 THEN 'accept' WHEN abs(n.price - w.ref) / abs(w.ref) >= 0.6 THEN 'fail' WHEN abs(n.price - w.ref) / abs(w.ref) >= 0.35 THEN 'quarantine' WHEN abs(n.price - w.ref) / abs(w.ref) >= 0.2 THEN 'warn' ELSE 'accept' END
  FROM walk w JOIN n ON n.symbol = w.symbol AND n.rn = w.rn + 1)
SELECT symbol, arrival_seq, decision FROM walk""")
def anomaly_accept_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.accept_loop(market_events(spark, sf_dir), ["symbol"]).select(*ID, "decision")


LATE = "max(event_us) OVER (PARTITION BY symbol ORDER BY available_us, arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@registered(f"{EV}, m AS (SELECT *, {LATE} AS mark FROM ev) SELECT symbol, arrival_seq, coalesce(event_us < mark, false) AS late, CASE WHEN event_us < mark THEN mark - event_us ELSE 0 END AS lateness_us FROM m")
def late_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.late_rows(market_events(spark, sf_dir), ["symbol"], order=["available_us", "arrival_seq"]).select(*ID, "late", "lateness_us")


@registered(f"{EV}, m AS (SELECT *, {LATE} AS mark FROM ev) SELECT symbol, arrival_seq FROM m WHERE mark IS NULL OR event_us >= mark")
def late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.late_rows(market_events(spark, sf_dir), ["symbol"], order=["available_us", "arrival_seq"], policy="drop").select(*ID)


@registered(f"{EV}, m AS (SELECT *, max(available_us) OVER ({ARRIVAL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM ev) SELECT symbol, arrival_seq FROM m WHERE mark IS NULL OR available_us >= mark")
def watermark_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.watermark_reject(market_events(spark, sf_dir), ["symbol"]).select(*ID)


@registered(f"""{EV}, m AS (SELECT *, {HIGH.replace('event_us', 'available_us', 1)} AS mark FROM ev), l AS (SELECT *, coalesce(available_us < mark, false) AS late FROM m)
SELECT symbol, arrival_seq, CAST(sum(CAST(late AS BIGINT)) OVER c AS BIGINT) AS late_so_far, max(CASE WHEN late THEN mark - available_us ELSE 0 END) OVER c AS worst_so_far FROM l WINDOW c AS ({ARRIVAL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def lateness_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    return gaps.cumulative_lateness(ev.withColumn("event_us", F.col("available_us")), ["symbol"]).select(*ID, "late_so_far", "worst_so_far")


@registered("""WITH q AS (SELECT l_shipdate, l_returnflag AS ds, l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS provider, CASE WHEN l_orderkey % 1000 = 0 THEN NULL ELSE 'x' END AS lineage FROM lineitem),
b AS (SELECT *, lag(epoch_us(l_shipdate)) OVER (PARTITION BY ds ORDER BY l_orderkey, l_linenumber, l_shipdate) AS before FROM q),
r AS (SELECT ds, count(*) AS rows, count(*) FILTER (WHERE provider IS NULL) AS missing_provider, count(*) FILTER (WHERE lineage IS NULL) AS missing_lineage, count(*) FILTER (WHERE epoch_us(l_shipdate) < before) AS out_of_order FROM b GROUP BY ds),
d AS (SELECT ds, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT ds, l_orderkey, l_shipdate, count(*) AS n FROM q GROUP BY ALL) GROUP BY ds)
SELECT *, greatest(0, 100 - 5 * duplicates - missing_provider - 3 * missing_lineage - 10 * out_of_order) AS score,
  CASE WHEN duplicates + missing_provider + missing_lineage + out_of_order = 0 THEN 'healthy' WHEN greatest(0, 100 - 5 * duplicates - missing_provider - 3 * missing_lineage - 10 * out_of_order) < 75 AND duplicates + missing_lineage + out_of_order > 0 THEN 'failed' ELSE 'degraded' END AS status
FROM r JOIN d USING (ds)""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("ds"), "l_orderkey", "l_linenumber", "l_shipdate", micros(F.col("l_shipdate")).alias("event_us"),
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("provider"), F.when(F.col("l_orderkey") % 1000 != 0, F.lit("x")).alias("lineage"),
    )
    return quality.quality_report(rows, ["ds"], ["l_orderkey", "l_shipdate"], "provider", "lineage", "event_us", ["l_orderkey", "l_linenumber", "l_shipdate"])


CATALOG = """c AS (SELECT 'n' || n_nationkey AS path, n_name AS venue, 'trade' AS stream FROM nation),
q AS (SELECT 'n' || s_nationkey AS path, CASE WHEN count(*) > 5 THEN 'healthy' ELSE 'degraded' END AS quality_status FROM supplier GROUP BY s_nationkey),
p AS (SELECT 'n' || c_nationkey AS path, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS targets FROM customer GROUP BY c_nationkey)"""


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lambda c: F.concat(F.lit("n"), F.col(c).cast("string")).alias("path")
    contracts = read_table(spark, sf_dir, "nation").select(path("n_nationkey"), F.col("n_name").alias("venue"), F.lit("trade").alias("stream"))
    known = read_table(spark, sf_dir, "supplier").groupBy(path("s_nationkey")).agg(F.when(F.count("*") > 5, "healthy").otherwise("degraded").alias("quality_status"))
    promoted = read_table(spark, sf_dir, "customer").select(path("c_nationkey"), F.col("c_mktsegment").alias("target"))
    return quality.catalog(contracts, known, promoted)


@registered(f"WITH {CATALOG} SELECT path, venue, stream, quality_status, targets FROM c LEFT JOIN q USING (path) LEFT JOIN p USING (path)")
def catalog_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir).select("path", "venue", "stream", "quality_status", "targets")


@registered(f"""WITH {CATALOG}, d AS (SELECT n_name AS venue, 'trade' AS stream, 'daily' AS delivery FROM nation WHERE n_regionkey < 3)
SELECT path, CASE WHEN quality_status = 'failed' THEN 'breached' WHEN delivery IS NULL THEN 'uncontracted' WHEN quality_status = 'degraded' THEN 'at_risk' WHEN quality_status IS NULL THEN 'unknown' ELSE 'met' END AS service_status
FROM c LEFT JOIN q USING (path) LEFT JOIN p USING (path) LEFT JOIN d USING (venue, stream)""")
def service_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = read_table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_name").alias("venue"), F.lit("trade").alias("stream"), F.lit("daily").alias("delivery"))
    return quality.service_levels(_catalog(spark, sf_dir), delivery).select("path", "service_status")


@registered(f"{EV} SELECT symbol, arg_max(arrival_seq, (event_us, arrival_seq)) AS arrival_seq, arg_max(price, (event_us, arrival_seq)) AS price, count(*) AS row_count FROM ev GROUP BY symbol")
def latest_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.curated(market_events(spark, sf_dir), ["symbol"]).select("symbol", "arrival_seq", "price", "row_count")


@registered(f"{EV} SELECT symbol, arrival_seq, price FROM ev WHERE symbol = 'U7' AND event_us <= {AT}")
def historical_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    return lake.query(ev, symbol="U7", end_us=_middle(ev)).select(*ID, "price")


@registered(f"""{EV}, p AS (SELECT symbol, kind, count(*) AS n, sum(price) AS v FROM ev GROUP BY ALL), s AS (SELECT symbol, kind, count(*) AS n, sum(price) AS v FROM ev WHERE arrival_seq % 11 <> 0 GROUP BY ALL)
SELECT symbol, kind, CAST(coalesce(s.n, 0) - coalesce(p.n, 0) AS BIGINT) AS row_diff, CAST(coalesce(s.n, 0) - coalesce(p.n, 0) AS BIGINT) AS identity_diff, coalesce(s.n, 0) <> coalesce(p.n, 0) AS significant FROM p FULL JOIN s USING (symbol, kind)""")
def shadow_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    row = compare.canonical_row("symbol", "event_us", "price", "size", floats=["price", "size"])
    snap = lambda df: compare.snapshot(df, ["symbol", "kind"], dedup.identity(df), row, "event_us")
    return compare.shadow_compare(snap(ev), snap(ev.where("arrival_seq % 11 <> 0")), ["symbol", "kind"]).select("symbol", "kind", "row_diff", "identity_diff", "significant")


@registered(f"""{EV}, a AS (SELECT symbol, event_us, price FROM ev WHERE arrival_seq % 7 <> 1), b AS (SELECT symbol, event_us, price + CASE WHEN arrival_seq % 13 = 0 THEN 1 ELSE 0 END AS price FROM ev WHERE arrival_seq % 5 <> 1), c AS (SELECT symbol, event_us, price + CASE WHEN arrival_seq % 17 = 0 THEN 0.5 ELSE 0 END AS price FROM ev WHERE arrival_seq % 3 <> 1)
SELECT * FROM (SELECT symbol, event_us, 'price' AS name, CASE WHEN a.price IS NULL THEN 'extra_online' WHEN b.price IS NULL THEN 'missing_batch' WHEN a.price <> b.price THEN 'persisted_batch_diverged' WHEN c.price IS NULL THEN 'missing_online' WHEN abs(a.price - c.price) > 1e-9 THEN 'tolerance_exceeded' END AS reason
FROM a LEFT JOIN b USING (symbol, event_us) FULL JOIN c USING (symbol, event_us)) WHERE reason IS NOT NULL""")
def parity_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    pick = lambda keep, value: ev.where(keep).select("symbol", "event_us", F.lit("price").alias("name"), value.alias("value"), F.col("arrival_seq").alias("ord"))
    price, n = F.col("price"), F.col("arrival_seq")
    return compare.parity(pick("arrival_seq % 7 <> 1", price), pick("arrival_seq % 5 <> 1", price + F.when(n % 13 == 0, 1.0).otherwise(0.0)), pick("arrival_seq % 3 <> 1", price + F.when(n % 17 == 0, 0.5).otherwise(0.0)), ["symbol", "event_us"])


@registered("""WITH e AS (SELECT CAST(event_id AS VARCHAR) AS k, event_id FROM events), a AS (SELECT k, row_number() OVER (ORDER BY event_id) AS place FROM e), b AS (SELECT k, row_number() OVER (ORDER BY event_id) AS place FROM e WHERE event_id % 500 <> 499)
SELECT place, a.k AS replayed, b.k AS stored FROM a FULL JOIN b USING (place) WHERE a.k IS DISTINCT FROM b.k""")
def replay_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("k"), "event_id")
    return compare.sequence_parity(rows.union(rows.where("event_id % 3 = 0")), rows.where("event_id % 500 <> 499"), "k", "event_id")


@registered("""WITH b AS (SELECT p_partkey, p_brand, p_size, p_retailprice FROM part WHERE p_partkey % 10 <> 1), a AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'x' ELSE p_brand END AS p_brand, p_size + CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE 0 END AS p_size, p_retailprice FROM part WHERE p_partkey % 10 <> 2),
j AS (SELECT p_partkey, b.p_brand AS bb, a.p_brand AS ab, b.p_size AS bs, a.p_size AS az FROM b FULL JOIN a USING (p_partkey)),
r AS (SELECT p_partkey, CASE WHEN bb IS NULL THEN 'added' WHEN ab IS NULL THEN 'removed' WHEN bb <> ab OR bs <> az THEN 'changed' END AS change, concat_ws(',', CASE WHEN bb <> ab THEN 'p_brand' END, CASE WHEN bs <> az THEN 'p_size' END) AS changed FROM j)
SELECT p_partkey, change, CASE WHEN change = 'changed' THEN changed END AS changed, change <> 'changed' OR changed LIKE '%p_size%' AS is_material FROM r WHERE change IS NOT NULL""")
def catalog_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    after = part.where("p_partkey % 10 <> 2").withColumns({"p_brand": F.when(k % 7 == 0, "x").otherwise(F.col("p_brand")), "p_size": F.col("p_size") + F.when(k % 9 == 0, 1).otherwise(0)})
    return compare.catalog_drift(part.where("p_partkey % 10 <> 1"), after, ["p_partkey"], ["p_brand", "p_size", "p_retailprice"], ["p_size"])


FLAG = "PARTITION BY symbol ORDER BY arrival_seq"


@registered(f"""{EV}, f AS (SELECT symbol, arrival_seq, price, lag(price) OVER w AS prev, count(*) OVER w4 AS n4, avg(CAST(price <= 20 AND price >= -20 AS DOUBLE)) OVER w4 AS sparse, count(*) OVER w5 AS n5, avg(price) OVER r2 AS recent, avg(price) OVER b3 AS base FROM ev
WINDOW w AS ({FLAG}), w4 AS ({FLAG} ROWS 3 PRECEDING), w5 AS ({FLAG} ROWS 4 PRECEDING), r2 AS ({FLAG} ROWS 1 PRECEDING), b3 AS ({FLAG} ROWS BETWEEN 4 PRECEDING AND 2 PRECEDING))
SELECT symbol, arrival_seq, concat_ws(',', CASE WHEN price < 5 THEN 'below_min' END, CASE WHEN price > 90 THEN 'above_max' END, CASE WHEN abs(price - prev) > 40 THEN 'delta_exceeded' END, CASE WHEN n4 >= 4 AND sparse > 0.5 THEN 'sparse_run' END, CASE WHEN n5 >= 5 AND abs(recent - base) > 25 THEN 'drift_shift' END) AS flags FROM f""")
def validator_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = {"min": 5, "max": 90, "max_abs_delta": 40, "sparsity_window": 4, "max_sparse_ratio": 0.5, "sparsity_epsilon": 20, "drift_baseline_window": 3, "drift_recent_window": 2, "max_mean_shift": 25}
    found = validators.series_flags(market_events(spark, sf_dir), ["symbol"], ["arrival_seq"], "price", policy)
    return found.select(*ID, F.array_join("flags", ",").alias("flags"))


@registered("""WITH b AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS open, l_extendedprice * (1 - l_discount) AS close, l_extendedprice * (1 + l_tax) AS high, l_extendedprice * (1 - l_discount) - l_tax AS low, l_quantity - 10 AS volume FROM lineitem)
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN volume < 0 THEN 'bad_volume' END, CASE WHEN high < greatest(open, close, low) THEN 'high_not_highest' END, CASE WHEN low > least(open, close, high) THEN 'low_not_lowest' END) AS reasons FROM b""")
def bars_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    rows = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit(1000).alias("open_ms"), F.lit(2000).alias("close_ms"), price.alias("open"), (price * (1 - F.col("l_discount"))).alias("close"), (price * (1 + F.col("l_tax"))).alias("high"),
        (price * (1 - F.col("l_discount")) - F.col("l_tax")).alias("low"), (F.col("l_quantity") - 10).alias("volume"),
    )
    return rows.select("l_orderkey", "l_linenumber", F.array_join(validators.bar_reasons(10_000), ",").alias("reasons"))


MESSAGE = """m AS (SELECT event_id, '{"stream":"x@trade","data":{"e":"' || CASE event_id % 3 WHEN 0 THEN 'aggTrade' ELSE 'trade' END || '","E":' || epoch_ms(ts) || ',"s":" u' || user_id || ' ","p":"' || CAST(value AS VARCHAR) || '","q":"2","t":' || event_id || CASE event_id % 4 WHEN 0 THEN ',"m":true' WHEN 1 THEN ',"m":false' ELSE '' END || CASE event_id % 10 WHEN 0 THEN ',"zz":1' ELSE '' END || '}}' AS payload FROM events)"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, k = read_table(spark, sf_dir, "events"), F.col("event_id")
    body = F.concat(
        F.lit('{"stream":"x@trade","data":{"e":"'), F.when(k % 3 == 0, "aggTrade").otherwise("trade"), F.lit('","E":'), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit(',"s":" u'), F.col("user_id").cast("string"),
        F.lit(' ","p":"'), F.col("value").cast("string"), F.lit('","q":"2","t":'), k.cast("string"), F.when(k % 4 == 0, ',"m":true').when(k % 4 == 1, ',"m":false').otherwise(""), F.when(k % 10 == 0, ',"zz":1').otherwise(""), F.lit("}}"),
    )
    return ev.select("event_id", body.alias("payload"))


@registered("""SELECT 'U' || user_id AS symbol, epoch_us(ts) // 1000 AS exchange_ms, value AS price, CAST(2 AS DOUBLE) AS size, CAST(event_id AS VARCHAR) AS trade_id, CASE event_id % 4 WHEN 0 THEN 'sell' WHEN 1 THEN 'buy' END AS side FROM events""")
def normalize_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize(_messages(spark, sf_dir))["trade"]
    return rows.select("symbol", F.unix_millis("exchange_ts").alias("exchange_ms"), "price", "size", "trade_id", "side")


@registered("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'zz' ELSE '' END AS unexpected, event_id % 10 = 0 AS drifted FROM events")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = normalize.schema_drift(normalize.open_envelope(_messages(spark, sf_dir)), {"trade": ("e", "E", "s", "p", "q", "t", "m"), "kline": (), "book": ()})
    return found.select("event_id", F.array_join("unexpected", ",").alias("unexpected"), "drifted")


@registered("SELECT o_orderkey, CASE WHEN d <= 7 THEN 'hot' WHEN d <= 30 THEN 'warm' ELSE 'cold' END AS tier FROM (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) AS d FROM orders)")
def tiering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "orders")
    end = rows.agg(F.max(F.to_date("o_orderdate"))).first()[0]
    return rows.select("o_orderkey", quality.tier(F.date_diff(F.lit(end), F.to_date("o_orderdate"))).alias("tier"))


@registered(f"{EV} SELECT symbol, arrival_seq FROM (SELECT *, row_number() OVER ({ARRIVAL}) AS rn FROM ev) WHERE (rn - 1) % 10 = 0")
def downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.downsample(market_events(spark, sf_dir), ["symbol"], ["arrival_seq"], 10).select(*ID)


@registered("""SELECT c_custkey, '{"account":"' || c_mktsegment || '","symbol":"U' || c_custkey || '"}' AS scope, CAST('0x' || substr(sha256('{"account":"' || c_mktsegment || '","symbol":"U' || c_custkey || '"}'), 1, 8) AS BIGINT) / 4294967295.0 < 0.25 AS canary FROM customer""")
def entity_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" u"), F.col("c_custkey").cast("string")).alias("symbol"), F.col("c_mktsegment").alias("account"), F.lit("  ").alias("venue"))
    return rows.select("c_custkey", scalars.entity_scope(["symbol", "account", "venue"]).alias("scope")).withColumn("canary", scalars.in_canary(F.col("scope"), 0.25))


@registered("""WITH s AS (SELECT o_orderkey, o_totalprice, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') AS age, o_orderstatus FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'missing' WHEN age > 1500 THEN 'stale' WHEN o_orderstatus = 'P' THEN 'quality_flagged' WHEN o_totalprice > 200000 THEN 'contract_mismatch' ELSE 'ok' END AS status FROM s""")
def serving_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "orders")
    age = F.date_diff(F.lit("1998-08-02").cast("date"), F.to_date("o_orderdate"))
    status = scalars.serving_status(F.col("o_orderkey") % 17 != 0, age, 1500, F.when(F.col("o_orderstatus") == "P", F.array(F.lit("p"))).otherwise(F.array().cast("array<string>")), F.lit(0.0), 0.5, F.col("o_totalprice") <= 200000)
    return rows.select("o_orderkey", status.alias("status"))


@registered("""WITH v AS (SELECT l_suppkey AS k, l_extendedprice AS x FROM lineitem), r AS (SELECT k, x, row_number() OVER (PARTITION BY k ORDER BY x) AS rn, count(*) OVER (PARTITION BY k) AS n FROM v)
SELECT k, x AS percentile FROM r WHERE rn = round_even((n - 1) * 0.95, 0) + 1""")
def nearest_rank_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_extendedprice").alias("x"))
    return quality.nearest_rank(rows, ["k"], "x", 0.95)


@registered(f"{EV}, b AS (SELECT * FROM ev WHERE event_us <= {AT}), l AS (SELECT * FROM ev WHERE arrival_seq % 2 = 0) SELECT symbol, arrival_seq, 'bootstrap' AS phase FROM b UNION ALL SELECT symbol, arrival_seq, 'live' FROM l ANTI JOIN b USING (arrival_seq)")
def handoff_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir)
    return lake.handoff(ev, ev.where("arrival_seq % 2 = 0"), "arrival_seq", 0, _middle(ev)).select(*ID, "phase")


@registered(f"""{EV}, both_ AS (SELECT *, 1 AS batch FROM ev UNION ALL SELECT * REPLACE (price + 1 AS price, arrival_seq + 1000000000 AS arrival_seq), 2 FROM ev WHERE arrival_seq % 4 = 0)
SELECT symbol AS entity_scope, event_us, arg_max(price, arrival_seq) AS price FROM both_ GROUP BY ALL""")
def store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = market_events(spark, sf_dir).select(F.col("symbol").alias("entity_scope"), "event_us", F.lit("s").alias("feature_set_name"), F.lit("v1").alias("feature_set_version"), F.lit("l").alias("lineage_id"), "price", "arrival_seq")
    new = rows.where("arrival_seq % 4 = 0").withColumns({"price": F.col("price") + 1, "arrival_seq": F.col("arrival_seq") + 1_000_000_000})
    return feature_store.upserted(rows, new).select("entity_scope", "event_us", "price")


@registered("""SELECT CAST(k AS VARCHAR) AS text, CASE WHEN k % 6 = 0 THEN k WHEN k % 6 = 1 THEN k * 60 WHEN k % 6 = 2 THEN k * 3600 WHEN k % 6 = 3 THEN k * 86400 WHEN k % 6 = 4 THEN k * 604800 ELSE NULL END AS seconds FROM (SELECT n_nationkey AS k FROM nation)""")
def interval_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    text = F.concat(k.cast("string"), F.element_at(F.array(*map(F.lit, ("s", "m", "h", "d", "w", "x"))), (k % 6 + 1).cast("int")))
    return read_table(spark, sf_dir, "nation").select(k.cast("string").alias("text"), scalars.interval_seconds(text).alias("seconds"))


@registered(f"{EV} SELECT symbol, arrival_seq AS raw_ingestion_seq, 'run' AS raw_run_id, epoch_us(event_ts) // 1000 AS exchange_ms, price, available_us AS process_us FROM ev WHERE event_us <= {AT}")
def replay_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = market_events(spark, sf_dir).withColumnRenamed("arrival_seq", "event_id").join(_messages(spark, sf_dir), "event_id")
    raw = ev.select("payload", F.col("event_ts").cast("timestamp").alias("exchange_ts"), F.col("available_ts").cast("timestamp").alias("receive_ts"), F.lit("run").alias("run_id"), F.col("event_id").alias("ingestion_seq"), "event_us")
    wanted = replay.window(raw, end=F.timestamp_micros(F.lit(_middle(ev))))
    return replay.replayed(wanted).select("symbol", "raw_ingestion_seq", "raw_run_id", F.unix_millis("exchange_ts").alias("exchange_ms"), "price", F.unix_micros("process_ts").alias("process_us"))


@registered(f"""{EV} SELECT symbol, CASE arrival_seq % 3 WHEN 0 THEN 'trade' WHEN 1 THEN 'kline' ELSE 'book' END AS kind, arrival_seq AS raw_ingestion_seq, epoch_us(event_ts) // 1000 AS exchange_ms,
  CASE WHEN arrival_seq % 3 <> 1 THEN price END AS price, CASE WHEN arrival_seq % 3 = 1 THEN price END AS close, CASE WHEN arrival_seq % 3 = 2 THEN CAST(arrival_seq AS VARCHAR) END AS sequence_id
FROM ev WHERE arrival_seq % 3 <> 1 OR arrival_seq % 2 = 0""")
def replay_all_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as raw messages, a third each trades, bars (half of them closed) and quotes, landed as JSON lines and replayed."""
    ev = read_table(spark, sf_dir, "events")
    n, ms, value = F.col("event_id"), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.col("value").cast("string")
    symbol = F.concat(F.lit('"s":"u'), F.col("user_id").cast("string"), F.lit('","E":'), ms)
    trade = F.concat(F.lit('{"e":"trade",'), symbol, F.lit(',"p":"'), value, F.lit('","q":"1"}'))
    bar = F.concat(F.lit('{"e":"kline",'), symbol, F.lit(',"k":{"t":'), ms, F.lit(',"T":'), ms, F.lit(',"c":"'), value, F.when(n % 2 == 0, '","q":"1","x":true}}').otherwise('","q":"1","x":false}}'))
    book = F.concat(F.lit('{"e":"bookTicker",'), symbol, F.lit(',"u":'), n.cast("string"), F.lit(',"b":"'), value, F.lit('","a":"'), value, F.lit('","B":"1","A":"1"}'))
    payload = F.when(n % 3 == 0, trade).when(n % 3 == 1, bar).otherwise(book)
    at = F.col("ts").cast("timestamp")
    path = scratch_path(spark, "raw")
    lake.write_raw(ev.select(payload.alias("payload"), F.lit("BINANCE").alias("venue"), F.lit("mixed").alias("stream_type"), at.alias("exchange_ts"), at.alias("receive_ts"), F.lit("run").alias("run_id"), n.alias("ingestion_seq")), path)
    found = replay.replayed(lake.read_raw(spark, path)[0], kinds=("trade", "kline", "book"))
    return found.select("symbol", "kind", "raw_ingestion_seq", F.unix_millis("exchange_ts").alias("exchange_ms"), "price", "close", "sequence_id")


@registered("""SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 2 ELSE 1 END AS attempts, CASE WHEN event_id % 9 = 0 THEN 'failed' ELSE 'replayed' END AS status,
  CASE WHEN event_id % 9 = 0 THEN 'missing_price' END AS error FROM events""")
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as quarantined messages, a ninth of them without a price, replayed twice against one ledger."""
    rows = _messages(spark, sf_dir)
    broken = F.when(F.col("event_id") % 9 == 0, F.regexp_replace("payload", '"p":"[^"]*"', '"p":"none"')).otherwise(F.col("payload"))
    held = _stored(quarantine.identified(rows.select("event_id", broken.alias("payload"), F.col("event_id").alias("quarantined_us"))), "quarantine")
    first = _stored(quarantine.replay(held, spark.createDataFrame([], quarantine.LEDGER), 1).ledger, "ledger")
    second = quarantine.replay(held, first, 2)
    last = first.unionByName(second.ledger).groupBy("record_id").agg(F.max(F.struct("attempt", "status", "error")).alias("last"))
    return held.select("event_id", "record_id").join(last, "record_id").select("event_id", F.col("last.attempt").alias("attempts"), "last.status", "last.error")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_events(spark, sf_dir).withColumns({"run_id": F.concat(F.lit("run-"), "kind"), "entity_scope": F.col("symbol")})


@registered(f"{EV} SELECT symbol, arrival_seq, price FROM ev WHERE kind = 'click' AND event_us <= {AT}")
def reconstruct_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return runs.reconstruct(vectors, "run-click", end_us=_middle(vectors)).select(*ID, "price")


@registered(f"""{EV} SELECT 'run-' || kind AS run_id, count(*) AS row_count, min(event_us) AS min_event_us, max(event_us) AS max_event_us, substr(sha256('d|f|run-' || kind), 1, 32) AS bundle_id FROM ev GROUP BY kind""")
def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each kind of event, recorded over a part and then over all; the later row stays."""
    vectors, known = _vectors(spark, sf_dir), None
    for order, part in ((1, vectors.where("price > 50")), (2, vectors)):
        known = runs.registered(known, runs.record_each(part, "d", "f").withColumn("registered_at", F.lit(order)), "registered_at")
    return known.select("run_id", "row_count", "min_event_us", "max_event_us", "bundle_id")


LOST = "(l_orderkey * 7 + l_linenumber) % 5"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("cursor"), F.lit(0).cast("bigint").alias("event_us"), F.expr(LOST).alias("mod"))


@registered(f"""WITH l AS (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS prev FROM lineitem WHERE {LOST} <> 0)
SELECT l_orderkey, CAST(prev + 1 AS BIGINT) AS first, CAST(l_linenumber - 1 AS BIGINT) AS last, CAST(l_linenumber AS BIGINT) AS boundary FROM l WHERE l_linenumber > prev + 1""")
def gap_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.requests(gaps.detect_gaps(_lines(spark, sf_dir).where("mod <> 0"), ["l_orderkey"], 1.0, ["cursor"]), ["l_orderkey"])


@registered(f"""WITH l AS (SELECT l_orderkey, l_linenumber AS n, {LOST} AS m FROM lineitem), e AS (SELECT l_orderkey, min(n) AS low, max(n) AS high FROM l WHERE m <> 0 GROUP BY ALL)
SELECT DISTINCT l_orderkey, CAST(n AS BIGINT) AS cursor, m = 0 AS recovered FROM l JOIN e USING (l_orderkey) WHERE n BETWEEN low AND high""")
def gap_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    kept = lines.where("mod <> 0")
    wanted = recovery.requests(gaps.detect_gaps(kept, ["l_orderkey"], 1.0, ["cursor"]), ["l_orderkey"])
    whole = recovery.merged(kept, recovery.asked_for(lines, wanted, ["l_orderkey"]), ["l_orderkey"])
    return whole.select("l_orderkey", "cursor", (F.col("mod") == 0).alias("recovered"))


@registered(f"""{EV} SELECT symbol, CAST(sum(CASE kind WHEN 'error' THEN 1 ELSE 0 END) AS BIGINT) AS gaps_total, CAST(count(*) AS BIGINT) AS messages_total, max(available_us - event_us) AS lag_max, count(*) FILTER (WHERE kind = 'error') > 0 AS degraded FROM ev GROUP BY symbol""")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = market_events(spark, sf_dir).select("symbol", F.when(F.col("kind") == "error", 1).alias("gaps_total"), F.lit(1).alias("messages_total"), (F.col("available_us") - F.col("event_us")).alias("lag_max"))
    return reports.merge_stream_metrics(rows, ["symbol"], ["gaps_total", "messages_total"], ["lag_max"])


SEVERITY = "CASE kind WHEN 'error' THEN 'critical' WHEN 'signup' THEN 'high' WHEN 'click' THEN 'medium' END"


@registered(f"""{EV}, r AS (SELECT price > 5 AS ok, {SEVERITY} AS severity FROM ev)
SELECT count(*) AS total_reports, count(*) FILTER (WHERE NOT ok) AS failed_reports, count(*) FILTER (WHERE NOT ok AND severity = 'critical') AS critical_failures, count(*) FILTER (WHERE NOT ok AND severity = 'high') AS high_failures,
  count(*) FILTER (WHERE NOT ok AND severity = 'medium') AS medium_failures, count(*) FILTER (WHERE NOT ok) <= 10 AND count(*) FILTER (WHERE NOT ok AND severity = 'critical') <= 3 AS pass_ok FROM r""")
def shadow_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.shadow_summary(market_events(spark, sf_dir).selectExpr("price > 5 AS pass_ok", f"{SEVERITY} AS severity"), 10, 3)


@registered("""SELECT count(*) AS total_requests, count(*) FILTER (WHERE o_orderstatus = 'O') AS ok_count, count(*) FILTER (WHERE o_orderstatus = 'F') AS degrade_count, 0 AS fail_count, count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) AS unknown_count, max(o_totalprice) AS max_seconds, false AS pass_ok FROM orders""")
def probe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.probe_summary(read_table(spark, sf_dir, "orders").selectExpr("CASE o_orderstatus WHEN 'O' THEN 'ok' WHEN 'F' THEN 'degrade' ELSE 'odd' END AS status", "o_totalprice AS seconds"))


@registered(f"""{EV}, p AS (SELECT symbol, count(*) AS n, arg_min(kind, (event_us, arrival_seq)) AS fr, min_by(arrival_seq, (event_us, arrival_seq)) AS fs, arg_max(kind, (event_us, arrival_seq)) AS lr, max_by(arrival_seq, (event_us, arrival_seq)) AS ls FROM ev GROUP BY symbol)
SELECT symbol, n AS row_count, substr(sha256(concat_ws('|', symbol, n, fr, fs, lr, ls)), 1, 16) AS dataset_version, substr(sha256(concat_ws('|', symbol, fr, fs, lr, ls)), 1, 16) AS lineage_id FROM p""")
def dataset_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dataset_versions(market_events(spark, sf_dir), ["symbol"], ["event_us", "arrival_seq"], "kind", "arrival_seq")


@registered("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'fail' WHEN o_orderkey % 7 = 0 THEN 'degrade' WHEN o_orderkey % 5 = 0 THEN 'fail' ELSE 'ok' END AS status, CASE WHEN o_orderstatus = 'P' THEN 'point_in_time_missing' WHEN o_orderkey % 7 = 0 THEN 'quality_flags' WHEN o_orderkey % 5 = 0 THEN 'contract_validation' END AS reason FROM orders""")
def pit_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit("stale"))).otherwise(F.array().cast("array<string>"))
    status, reason = reports.point_in_time_status(F.col("o_orderstatus") != "P", flags, F.col("o_orderkey") % 5 != 0, "paper")
    return read_table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), reason.alias("reason"))


@registered("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 11 > 8 THEN 'parity_mismatch' END, CASE WHEN o_orderkey % 3 > 0 THEN 'stale_features_detected' END, CASE WHEN o_orderkey % 4 > 2 THEN 'latency_slo_breached' END) AS reasons, o_orderkey > 0 AND o_orderkey % 10 = 0 AS alert FROM orders""")
def release_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, none = F.col("o_orderkey"), F.lit(0)
    why = reports.gate_reasons(k % 11, k % 3, F.when(k % 4 > 2, 1), none, none, 8)
    return read_table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(why, ",").alias("reasons"), reports.alerts(k, 10).alias("alert"))


@registered(f"{EV} SELECT symbol, CAST((max(event_us) - min(event_us)) // 3600000000 + 1 AS BIGINT) AS bars FROM ev GROUP BY symbol")
def expected_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = market_events(spark, sf_dir).groupBy("symbol").agg(F.min("event_us").alias("low"), F.max("event_us").alias("high"))
    return span.select("symbol", reports.expected_bars(F.col("low"), F.col("high"), 3_600_000_000).alias("bars"))


@registered("SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS symbol, n_name AS base FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def instrument_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = read_table(spark, sf_dir, "nation").select(F.struct(F.col("n_nationkey").cast("string").alias("symbol"), F.lit("TRADING").alias("status"), F.col("n_name").alias("baseAsset"), F.lit("USDT").alias("quoteAsset")).alias("one"))
    listing = each.agg(F.to_json(F.struct(F.collect_list("one").alias("symbols"))).alias("payload"))  # one exchange's listing, a document of its own
    events = read_table(spark, sf_dir, "supplier").select("s_suppkey", F.lit("spot ").alias("venue"), F.col("s_nationkey").cast("string").alias("symbol"))
    return instruments.stamped(events, instruments.flattened(listing, "Spot"), ["base"]).select("s_suppkey", "symbol", "base")


@registered(f"{EV} SELECT symbol, arrival_seq, price * 2 AS price, CAST(1 AS BIGINT) AS n FROM ev")
def transformed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.create_map(F.lit("price"), F.col("price"), F.lit("window_max"), F.col("price"), F.lit("broken"), F.lit(float("nan")))
    vectors = market_events(spark, sf_dir).select(*ID, values.alias("values"))
    back = transformers.from_json(transformers.as_json(transformers.transformed(vectors, ["clip_non_finite", "scale_price_2x", "drop_window_max"])).select("payload"), "symbol string, arrival_seq bigint, values map<string,double>")
    return back.select(*ID, F.col("values")["price"].alias("price"), F.size("values").cast("bigint").alias("n"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A table of its own, as an earlier run has left it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@registered(f"{EV} SELECT symbol, arrival_seq, kind, price FROM ev")
def lake_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, appended twice as a lake of snapshots by kind, compacted to the first of each arrival number and read back."""
    lake_of = snapshots.SnapshotTable(spark, scratch_path(spark, "lake"), ["kind"], ["arrival_seq"])
    events = market_events(spark, sf_dir).select(*ID, "kind", "price")
    for _ in range(2):
        lake_of.append(events, files=4)
    lake_of.compact(dedup_key=["arrival_seq"], files=2)
    return lake_of.read()


@registered("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'k.c' ELSE '' END AS mismatched, CASE WHEN event_id % 11 = 0 THEN 'k.new,k.new.at' ELSE '' END AS unexpected, event_id % 7 = 0 OR event_id % 11 = 0 AS drifted FROM events""")
def schema_drift_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar messages of all events: some with the close as a number, some with an object more, half with their keys turned round."""
    n, value = F.col("event_id"), F.col("value").cast("string")
    close = F.when(n % 7 == 0, F.concat(F.lit('"c":'), F.col("event_id").cast("string"), F.lit(".5"))).otherwise(F.concat(F.lit('"c":"'), value, F.lit('"')))
    more = F.when(n % 11 == 0, ',"new":{"at":1}').otherwise("")
    rest = F.concat(*[F.concat(F.lit(f',"{k}":"'), value, F.lit('"')) for k in "ohlq"])
    times = F.concat(F.lit('"t":'), n.cast("string"), F.lit(',"T":'), n.cast("string"))
    bar = F.when(n % 2 == 0, F.concat(F.lit("{"), times, F.lit(","), close, rest, more, F.lit("}"))).otherwise(F.concat(F.lit("{"), close, rest, more, F.lit(","), times, F.lit("}")))
    head = F.concat(F.lit('"e":"kline","s":"u'), F.col("user_id").cast("string"), F.lit('","E":'), n.cast("string"))
    body = F.when(n % 2 == 0, F.concat(F.lit("{"), head, F.lit(',"k":'), bar, F.lit("}"))).otherwise(F.concat(F.lit('{"k":'), bar, F.lit(","), head, F.lit("}")))
    opened = normalize.open_envelope(read_table(spark, sf_dir, "events").select("event_id", body.alias("payload")))
    found = shapes.nested_drift(opened)
    return found.select("event_id", F.array_join("mismatched", ",").alias("mismatched"), F.array_join("unexpected", ",").alias("unexpected"), "drifted")


@registered(f"""{EV} SELECT symbol, arrival_seq, {s6(RET)} AS ret_1, {s6(full('avg', 20))} AS sma_20, {s6(full('max', 5))} AS max_5 FROM ev""")
def recompute_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the rows that came in time, then of those that came late: the same as of all rows at once."""
    events = _stored(gaps.late_rows(market_events(spark, sf_dir), ["symbol"], "available_us"), "events")
    graph = FeatureSet("late", "v1", (node("ret_1", "return", "price"), node("sma_20", "rolling", "price", window=20, aggregator="sma"), node("max_5", "rolling", "price", window=5, aggregator="max")))
    made = _stored(features.compute(events.where("not late"), graph), "features")
    whole = recompute.recompute(made, events.where("late"), graph)
    return _rounded(whole, "ret_1", "sma_20", "max_5")


@registered("""SELECT event_type AS symbol, event_id AS arrival_seq, value + CASE WHEN day(ts) % 2 = 0 THEN 1 ELSE 0 END AS price, CASE WHEN day(ts) % 2 = 0 THEN 'n2' END AS normalizer_version FROM events""")
def versioned_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events by kind and day in the layout of before, those of even days anew in the layout of now: each partition from where it is newest."""
    base = scratch_path(spark, "layouts")
    rows = read_table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"), F.col("event_id").alias("arrival_seq"), F.col("value").alias("price"))
    anew = rows.where(F.day("date") % 2 == 0).select(F.lit("prod").alias("env"), F.lit("BINANCE").alias("venue"), "symbol", "date", "arrival_seq", (F.col("price") + 1).alias("price"))
    put = lambda df, at, by: df.repartition("symbol", "date").write.partitionBy(*by).parquet(at)
    put(versions.stamped(rows, "v1"), f"{base}/prod", ("symbol", "date"))
    put(versions.stamped(anew, "v2", "n2"), f"{base}/trades", lake.PARTITIONS)
    return versions.read_layouts(spark, base, "trades", "prod", by_partition=True).select(*ID, "price", "normalizer_version")


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as normalized trades; the metadata of some lack a key of either mode, some are raw trades."""
    n, text = F.col("arrival_seq"), F.col("arrival_seq").cast("string")
    keys = {c: F.lit("x") for c in (*contracts.KEYS, *contracts.STRICT_KEYS)}
    keys |= {"instrument_snapshot": F.when(n % 7 != 0, "x"), "raw_run_id": F.when(n % 5 != 0, "x").otherwise(""), contracts.FEED_KIND: F.lit("aggregate_trade")}
    rows = market_events(spark, sf_dir)
    fixed = {c: F.lit("x") for c in (*contracts.COLUMNS, *contracts.STRICT_COLUMNS, "trade_id", "side") if c not in ("symbol", "event_ts", "source", "metadata")}
    more = {"env": F.lit("prod"), "venue": F.lit("BINANCE"), "date": F.to_date("event_ts"), contracts.FEED_KIND: F.when(n % 11 == 0, "raw_trade"), "raw_run_id": F.col("kind"), "raw_ingestion_seq": text}
    return rows.withColumns(fixed | more | {"metadata": F.create_map(*[part for k, v in keys.items() for part in (F.lit(k), v)])})


CONTRACT = f"""{EV}, f AS (SELECT symbol, CAST(event_ts AS DATE) AS date, count(*) AS row_count, min_by(arrival_seq, (event_us, arrival_seq)) AS n FROM ev GROUP BY ALL),
c AS (SELECT symbol, date, row_count, n % 7 <> 0 AND n % 11 <> 0 AS relaxed, n % 7 <> 0 AND n % 5 <> 0 AND n % 11 <> 0 AS strict, n FROM f)"""


@registered(f"""{CONTRACT} SELECT symbol, date, row_count, concat_ws(',', CASE WHEN n % 7 = 0 THEN 'instrument_snapshot' END, CASE WHEN n % 5 = 0 THEN 'raw_run_id' END) AS missing_keys,
CASE WHEN n % 11 = 0 THEN 'raw_trade' ELSE 'aggregate_trade' END AS historical_feed_kind, strict AS pass_ok FROM c""")
def contract_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contracts.records(_normalized(spark, sf_dir), ["event_us", "arrival_seq"])
    return found.select("symbol", "date", "row_count", F.array_join("missing_keys", ",").alias("missing_keys"), contracts.FEED_KIND, "pass_ok")


@registered(f"""{CONTRACT}, h AS (SELECT symbol, CAST(event_ts AS DATE) AS date, count(*) FILTER (arrival_seq % 200 = 0) AS lost FROM ev GROUP BY ALL),
r AS (SELECT symbol, date, concat_ws(',', CASE WHEN NOT strict AND relaxed THEN '{contracts.REASON_COMPAT_ONLY}' WHEN NOT strict THEN '{contracts.REASON_CONTRACT}' END, CASE WHEN lost > 0 THEN '{contracts.REASON_PARITY}' END) AS reasons FROM c JOIN h USING (symbol, date))
SELECT symbol, date, reasons, reasons = '' AS promoted FROM r""")
def dataset_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of all events for paper trading; the replay lacks every 200th event, and repeats some."""
    rows, order = _normalized(spark, sf_dir), ["event_us", "arrival_seq"]
    replayed = rows.where("arrival_seq % 200 <> 0")
    differing = contracts.parity(replayed.union(replayed.where("arrival_seq % 3 = 0")), rows, contracts.PARTITION, "arrival_seq", order)
    strict, relaxed = contracts.records(rows, order), contracts.records(rows, order, contracts.COMPAT)
    return contracts.promotions(strict, relaxed, differing, "paper").select("symbol", "date", F.array_join("reasons", ",").alias("reasons"), "promoted")


@registered(f"""{EV}, e AS (SELECT symbol, count(*) AS row_count, count(*) FILTER (day(event_ts) <= 15) AS early FROM ev GROUP BY symbol)
SELECT symbol, early AS row_count, 1 AS valid_from_us, CASE WHEN early < row_count THEN 2 END AS valid_to_us FROM e WHERE early > 0
UNION ALL SELECT symbol, row_count, 2, NULL FROM e WHERE early < row_count""")
def contract_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after the first half of a month, then after the whole, then once more with nothing new."""
    rows, order, part = _normalized(spark, sf_dir), ["event_us", "arrival_seq"], ("env", "venue", "symbol")
    half, whole = (contracts.records(df, order, partition=part) for df in (rows.where(F.day("event_ts") <= 15), rows))
    history = contracts.merged(contracts.merged(None, half, 1), whole, 2)
    out = contracts.merged(history, whole, 3).select("symbol", "row_count", "valid_from_us", "valid_to_us")
    return out.withColumns({c: F.col(c).cast("int") for c in ("valid_from_us", "valid_to_us")})


@registered("""WITH e AS (SELECT 'BINANCE:U' || user_id || ':trade' AS scope, event_id AS n, 'run-' || event_type AS run FROM events)
SELECT scope, CASE WHEN max(n) % 10 = 0 OR max(n) % 4 > 0 THEN 'degraded' ELSE 'ok' END AS status, coalesce(max_by(run, n) FILTER (n % 10 <> 0), min_by(run, n)) AS run_id FROM e GROUP BY scope""")
def telemetry_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as telemetry, one of ten as health and the rest as summaries of their user's stream, landed by a stream and folded."""
    base, n = scratch_path(spark, "telemetry"), F.col("event_id")
    said = [F.lit("live").alias("mode"), F.concat(F.lit("run-"), "event_type").alias("trace_id"), F.format_string("at %012d", n).alias("recorded_at")]
    symbol = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    one = F.struct(F.lit("binance").alias("venue"), symbol.alias("symbol"), F.lit("trade").alias("stream_type"), (n % 4).alias("gaps_total"))
    rows = read_table(spark, sf_dir, "events")
    rows.where(n % 10 != 0).select(F.to_json(F.struct(*said, F.array(one).alias("stream_metrics")))).write.text(f"{base}/in/{telemetry.SUMMARY}")
    rows.where(n % 10 == 0).select(F.to_json(F.struct(*said, F.array(F.concat(F.lit("BINANCE:"), symbol, F.lit(":trade"))).alias("streams_degraded")))).write.text(f"{base}/in/{telemetry.HEALTH}")
    telemetry.land(spark, f"{base}/in", f"{base}/log", f"{base}/state", "*.txt").awaitTermination()
    return telemetry.streams(telemetry.landed(spark, f"{base}/log")).select("scope", "status", "run_id")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
