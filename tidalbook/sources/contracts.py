"""Contracts of dataset partitions, their registry over time, and promotion.

``records`` looks at all partitions of a feed in one aggregate: rows, what the
first and the last row say, and which columns and metadata keys a contract asks
for and does not find. The strict mode asks for more than the compat mode, which
only passes old data on and approves nothing.

``merged`` keeps the registry as records with the time from which to which they
hold. A record that differs closes the one before; one that says the same leaves
it open; ``as_of`` asks for what held at a time. ``promotions`` approves those
partitions that pass the strict contract and whose replay gives the stored rows
in the stored order; ``approved`` keeps one entry for each target and partition.

Defined cases: a partition without rows has no record. Null partition values are
a partition of their own. Ties in ``order`` are broken by the row's identity
columns that the caller puts last in ``order``. Repeated records of one
partition are one: the last by version. A merge at or before the time of an open
record gives that record an empty range, which ``as_of`` never returns. Empty
tables give empty tables. Columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.operators.dedup import keep_first
from tidalbook.operators.scan import AUTO, Width, fresh, positions, spread

STRICT, COMPAT = "strict", "compat"
PARTITION = ("env", "venue", "symbol", "date")

# Columns and metadata keys that contracts ask for.
COLUMNS = ("venue", "feed_type", "normalizer_version", "symbol", "exchange_ts", "receive_ts", "process_ts", "event_ts", "source", "source_id", "metadata")
STRICT_COLUMNS = ("provider_ts", "raw_run_id", "raw_ingestion_seq")
FEED_COLUMNS = {
    "trade": ("price", "size", "trade_id", "side"),
    "kline": ("open", "high", "low", "close", "volume", "interval", "open_ts", "close_ts"),
    "book": ("bid_price", "bid_size", "ask_price", "ask_size", "sequence_id"),
    "unknown": (),
}
KEYS = ("instrument_catalog_version", "instrument_snapshot", "metadata_source", "venue_snapshot_version", "normalizer_version")
STRICT_KEYS = ("raw_run_id", "raw_ingestion_seq", "metadata_snapshot_mode", "instrument_catalog_snapshot_json")
#: Columns that tell a feed, looked for in this order.
TELLING = {"trade": ("trade_id", "side"), "kline": ("open", "high", "low", "close", "volume"), "book": ("bid_price", "bid_size", "ask_price", "ask_size")}
FEED_KIND = "historical_feed_kind"
#: The kind of history that trades must be.
TRADE_KIND = "aggregate_trade"
TARGETS = {"trade": ("research", "backtesting", "paper", "live"), "kline": ("research", "backtesting", "paper", "live"), "book": ("research", "backtesting")}
USAGES = {"aggregate_trade": ("aggregate_trade",), "raw_trade": ("aggregate_trade", "raw_trade_history")}

REASON_COMPAT_ASKED = "compat mode cannot approve datasets"
REASON_COMPAT_ONLY = "passes the contract in compat mode only"
REASON_CONTRACT = "fails the strict contract"
REASON_PARITY = "fails replay parity"


def feed_of(columns: Sequence[str]) -> str:
    """The feed that a table's columns tell."""
    return next((feed for feed, names in TELLING.items() if set(names) <= set(columns)), "unknown")


def required(feed: str, mode: str = STRICT) -> tuple[list[str], list[str]]:
    """(columns, metadata keys) that a contract asks for, sorted."""
    columns, keys = {*COLUMNS, *FEED_COLUMNS[feed]}, set(KEYS)
    if mode == STRICT:
        columns, keys = columns | set(STRICT_COLUMNS), keys | set(STRICT_KEYS)
    if feed == "trade":
        keys.add(FEED_KIND)
        columns |= {FEED_KIND} if mode == STRICT else set()
    return sorted(columns), sorted(keys)


def _texts(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _digest(*parts: Column) -> Column:
    return F.substring(F.sha2(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 256), 1, 16)


def records(rows: DataFrame, order: Sequence[str], mode: str = STRICT, partition: Sequence[str] = PARTITION) -> DataFrame:
    """Per partition of one feed's rows its contract record.

    ``order`` is the order of rows in a partition. ``metadata`` is a map of
    strings. Feed kind and versions are the first row's, by column, then by
    metadata. What a table lacks as a column counts as null.
    """
    feed = feed_of(rows.columns)
    columns, keys = required(feed, mode)
    have = lambda c, t="string": F.col(c).cast(t) if c in rows.columns else F.lit(None).cast(t)
    said = F.struct(have("metadata", "map<string,string>").alias("metadata"), *[have(c).alias(c) for c in ("normalizer_version", FEED_KIND, "raw_run_id", "raw_ingestion_seq")])
    at = F.struct(*order)
    names = dict(zip(partition, fresh(partition, *[f"part_{c}" for c in partition]), strict=True))  # kept from clashing with what follows
    ends = rows.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.count("*").alias("row_count"), F.min_by(said, at).alias("first"), F.max_by(said, at).alias("last"))
    told = lambda c: F.coalesce(F.nullif(F.trim(F.col(f"first.{c}")), F.lit("")), F.nullif(F.trim(F.col("first.metadata")[c]), F.lit("")))
    missing_keys = F.filter(_texts(keys), lambda k: F.coalesce(F.col("first.metadata")[k], F.lit("")) == "")
    missing_columns = [c for c in columns if c not in rows.columns]
    wrong_kind = ~told(FEED_KIND).eqNullSafe(F.lit(TRADE_KIND)) if feed == "trade" else F.lit(False)
    identity = F.concat_ws("/", F.lit(feed), *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(n).cast("string"), F.lit(""))) for c, n in names.items()])
    out = ends.withColumns({"dataset_id": identity, "missing_keys": missing_keys, FEED_KIND: told(FEED_KIND), "normalizer_version": told("normalizer_version")})
    passes = F.lit(not missing_columns) & (F.size("missing_keys") == 0) & ~wrong_kind
    lineage = [F.col(f"{end}.{c}") for end in ("first", "last") for c in ("raw_run_id", "raw_ingestion_seq")]
    out = out.withColumns({"pass_ok": passes, "kind_ok": ~wrong_kind})
    return out.select(
        "dataset_id",
        *[F.col(n).alias(c) for c, n in names.items()],
        F.lit(feed).alias("stream_type"),
        F.lit(mode).alias("contract_mode"),
        "row_count",
        _texts(missing_columns).alias("missing_columns"),
        "missing_keys",
        "kind_ok",
        "pass_ok",
        "normalizer_version",
        FEED_KIND,
        _texts(TARGETS.get(feed, TARGETS["book"])).alias("approved_targets"),
        _digest(F.col("dataset_id"), F.lit(mode), F.col("pass_ok"), F.col("row_count"), F.col("first.normalizer_version"), *lineage).alias("dataset_version"),
        _digest(F.col("dataset_id"), *lineage, F.col(f"first.{FEED_KIND}")).alias("lineage_id"),
    )


def merged(history: DataFrame | None, found: DataFrame, now_us: int, whole: bool = False) -> DataFrame:
    """The registry with the records ``found`` now: (record columns, valid_from_us, valid_to_us), null where they still hold.

    With ``whole`` the records are all that there are, and open ones of other
    partitions are closed; otherwise those stay open.
    """
    latest = found.groupBy("dataset_id").agg(F.max_by(F.struct(*found.columns), "dataset_version").alias("record")).select("record.*")
    now, never = F.lit(now_us).cast("bigint"), F.lit(None).cast("bigint")
    opened = latest.withColumns({"valid_from_us": now, "valid_to_us": never})
    if history is None:
        return opened
    past, current = history.where("valid_to_us is not null"), history.where("valid_to_us is null")
    columns = opened.columns
    both = current.select("dataset_id", F.struct(*columns).alias("old")).join(opened.select("dataset_id", F.struct(*columns).alias("new")), "dataset_id", "full_outer")
    same = F.struct(*[f"old.{c}" for c in found.columns]) == F.struct(*[f"new.{c}" for c in found.columns])
    closed = F.col("old").withField("valid_to_us", now)
    kept = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull(), F.array(closed if whole else F.col("old")))
        .when(same, F.array("old"))
        .otherwise(F.array(closed, F.col("new")))
    )
    return past.select(*columns).unionByName(both.select(F.explode(kept).alias("record")).select("record.*"))


def as_of(history: DataFrame, at_us: int) -> DataFrame:
    """Records that held at a time, each partition at most once."""
    return history.where((F.col("valid_from_us") <= at_us) & (F.col("valid_to_us").isNull() | (F.col("valid_to_us") > at_us)))


def parity(replayed: DataFrame, stored: DataFrame, partition: Sequence[str], key: str, order: Sequence[str], width: Width = AUTO) -> DataFrame:
    """Per partition: places at which the replayed and the stored keys, each once and in order, differ.

    Rows without a key are one key, as rows of one key are.
    """
    place, side = fresh([*partition, key], "place", "side")

    def placed(rows: DataFrame, as_name: str) -> DataFrame:
        once = keep_first(rows.select(*dict.fromkeys([*partition, key, *order])), [*partition, key], [c for c in order if c not in partition])
        at = positions(once, list(partition), list(order), place, spread(once, list(partition), list(order), width))
        return at.select(*partition, place, F.struct(F.col(key).cast("string").alias("key")).alias(side)).withColumnsRenamed({side: as_name})

    left, right = placed(replayed, "replayed"), placed(stored, "stored")
    of = fresh([*left.columns, *right.columns], *[f"of_{c}" for c in (*partition, place)])
    right = right.withColumnsRenamed(dict(zip((*partition, place), of, strict=True)))
    both = left.join(right, [F.col(c).eqNullSafe(F.col(o)) for c, o in zip((*partition, place), of, strict=True)], "full_outer")
    there = F.col("replayed").isNotNull()
    out = both.select(*[F.when(there, F.col(c)).otherwise(F.col(o)).alias(c) for c, o in zip(partition, of, strict=False)], "replayed", "stored")
    return out.groupBy(*partition).agg(F.count("replayed").alias("replayed"), F.count("stored").alias("stored"), F.count_if(~F.col("replayed").eqNullSafe(F.col("stored"))).alias("differing"))


def promotions(strict: DataFrame, compat: DataFrame, differing: DataFrame, target: str, partition: Sequence[str] = PARTITION, asked_mode: str = STRICT) -> DataFrame:
    """Strict records with ``target``, ``usages``, ``reasons`` and ``promoted``: true where there is no reason against it.

    ``compat`` are the records of the compat mode, ``differing`` is from
    ``parity``. A partition that was not replayed fails parity.
    """
    relaxed = compat.select(F.col("dataset_id").alias("relaxed_id"), F.col("pass_ok").alias("relaxed_ok"))
    of = fresh([*strict.columns, "relaxed_id", "relaxed_ok"], *[f"of_{c}" for c in partition], "places")
    replay = differing.select(*[F.col(c).alias(o) for c, o in zip(partition, of, strict=False)], F.col("differing").alias(of[-1]))
    joined = strict.join(relaxed, F.col("dataset_id") == F.col("relaxed_id"), "left").join(replay, [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(partition, of, strict=False)], "left")
    failed = ~F.col("pass_ok")
    only_compat = failed & F.coalesce("relaxed_ok", F.lit(False))
    why = F.array_compact(
        F.array(
            F.lit(REASON_COMPAT_ASKED if asked_mode != STRICT else None).cast("string"),
            F.when(only_compat, REASON_COMPAT_ONLY).when(failed, REASON_CONTRACT),
            F.when(F.coalesce(F.col(of[-1]), F.lit(1)) > 0, REASON_PARITY),
        )
    )
    usages = F.lit(None)
    for kind, names in USAGES.items():
        usages = F.when((F.col("stream_type") == "trade") & (F.col(FEED_KIND) == kind), _texts(names)).otherwise(usages)
    out = joined.select(*strict.columns, F.lit(target).alias("target"), F.coalesce(usages, _texts(())).alias("usages"), why.alias("reasons"))
    return out.withColumn("promoted", F.size("reasons") == 0)


def approved(registry: DataFrame | None, reports: DataFrame, now_us: int) -> DataFrame:
    """The registry of approved partitions with those that ``reports`` promote; the newest of a target and partition stays.

    Reports against promotion change nothing: what was approved stays approved.
    """
    new = reports.where("promoted").select("target", "dataset_id", "stream_type", FEED_KIND, "usages", "dataset_version", F.lit(now_us).cast("bigint").alias("registered_us"))
    both = new if registry is None else registry.select(*new.columns).unionByName(new)
    return both.groupBy("target", "dataset_id").agg(F.max_by(F.struct(*new.columns[2:]), F.struct("registered_us", "dataset_version")).alias("entry")).select("target", "dataset_id", "entry.*")


def usage_refused(asked: DataFrame, registry: DataFrame) -> DataFrame:
    """(target, dataset_id, usage, reason): asked uses that the registry does not allow; a null usage asks for approval alone."""
    known = registry.select(F.col("target").alias("of_target"), F.col("dataset_id").alias("of_id"), "stream_type", FEED_KIND, "usages")
    joined = asked.join(known, (F.col("target") == F.col("of_target")) & (F.col("dataset_id") == F.col("of_id")), "left")
    reason = (
        F.when(F.col("of_id").isNull(), "not approved for the target")
        .when(F.col("usage").isNull() | F.array_contains("usages", F.col("usage")), F.lit(None))
        .when(F.col("stream_type") != "trade", "no trade dataset")
        .when((F.col(FEED_KIND) == TRADE_KIND) & (F.col("usage") == "raw_trade_history"), "aggregated trades are no raw trade history")
        .otherwise("usage does not fit the feed kind")
    )
    return joined.select("target", "dataset_id", "usage", reason.alias("reason")).where("reason is not null")
