"""A read model of telemetry: landed exactly once from JSON lines, folded into runs, streams, alerts and checkpoints.

``land`` follows a folder with Spark's file source. Writers roll their files: a
file is read once, when it is there. Each micro-batch writes a folder of its
own number, so a batch that is done over after a failure replaces itself and
nothing is taken twice. The tables are aggregates over what has landed, by run
or stream, with partial stages; they do not depend on how lines fell into
batches, as events have an order of their own: by time, then by the text of the
time, then by the text of the event.

The kind of an event is in the name of its file or of the folder that the file
is in. Lines of other kinds and lines that are no JSON objects are not landed.
Events without a trace are runs of their env, mode and time. Repeated lines
change nothing. No lines give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SUMMARY, HEALTH, ALERT, CHECKPOINT = "ingestion_summary", "ingestion_health", "operational_alert", "checkpoint_audit_ref"
LANDED = "kind string, recorded_at string, run_id string, body string"
# Counters of a stream that make it degraded, and defaults.
DEGRADING = ("messages_invalid_total", "invalid_timestamp_total", "duplicates_total", "gaps_total", "gap_irreparable_total", "heartbeat_missed_total", "buffer_dropped_total")
DEFAULT_VENUE, DEFAULT_SYMBOL, UNKNOWN = "BINANCE", "UNKNOWN", "unknown"


def _get(value: str, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col(value), f"$.{name}", kind)


def _filled(value: Column, default: Column | str) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default) if isinstance(default, str) else default)


def events(lines: DataFrame) -> DataFrame:
    """(kind, recorded_at, run_id, body) of lines (value, file)."""
    kind = F.regexp_extract("file", f"({SUMMARY}|{HEALTH}|{ALERT}|{CHECKPOINT})[^/]*(/[^/]*)?$", 1)
    told = lines.select(kind.alias("kind"), F.trim("value").alias("body")).withColumn("said", F.try_parse_json("body")).where((F.col("kind") != "") & F.col("body").startswith("{") & F.col("said").isNotNull())
    recorded = _get("said", "recorded_at")
    own = F.concat_ws(":", F.coalesce(_get("said", "env"), F.lit(UNKNOWN)), F.coalesce(_get("said", "mode"), F.lit(UNKNOWN)), F.coalesce(recorded, F.lit(UNKNOWN)))
    return told.select("kind", recorded.alias("recorded_at"), _filled(_get("said", "trace_id"), own).alias("run_id"), "body")


def land_batch(lines: DataFrame, log: str, batch: int) -> None:
    """Write one batch's events where only this batch writes."""
    events(lines).write.mode("overwrite").parquet(f"{log.rstrip('/')}/batch={batch}")


def land(spark: SparkSession, source: str, log: str, checkpoint: str, glob: str = "*.jsonl", max_files: int = 10_000) -> StreamingQuery:
    """Land what is in the folders of ``source`` now and has not landed yet; the query ends by itself."""
    lines = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files).load(source)
    told = lines.select("value", F.col("_metadata.file_path").alias("file"))
    return told.writeStream.foreachBatch(lambda df, batch: land_batch(df, log, batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LANDED).parquet(log).select("kind", "recorded_at", "run_id", "body")


def _at() -> Column:
    return F.struct(F.expr("try_cast(recorded_at AS timestamp)").alias("us"), F.col("recorded_at").alias("said"), F.col("body").alias("text"))


def runs(found: DataFrame) -> DataFrame:
    """Per run its newest state: env, mode, result, when and what its last summary and health said."""
    rows = found.where(F.col("kind").isin(SUMMARY, HEALTH)).withColumns({"said": F.try_parse_json("body"), "at": _at()})
    summary, health = F.col("kind") == SUMMARY, F.col("kind") == HEALTH
    result = _get("said", "result")
    rows = rows.withColumns({"result": F.when(summary, F.coalesce(result, F.lit(UNKNOWN))).otherwise(result), **{c: F.coalesce(_get("said", c), F.lit(UNKNOWN)) for c in ("env", "mode")}})
    last = lambda value, of=None: F.max_by(value, "at" if of is None else F.when(of, F.col("at")))
    return rows.groupBy("run_id").agg(
        last("env").alias("env"),
        last("mode").alias("mode"),
        F.coalesce(last("result", F.col("result").isNotNull()), F.lit(UNKNOWN)).alias("result"),
        last("recorded_at").alias("updated_at"),
        last("recorded_at", summary).alias("last_summary_at"),
        last("recorded_at", health).alias("last_health_at"),
        last("body", summary).alias("summary"),
        last("body", health).alias("health"),
    )


def streams(found: DataFrame) -> DataFrame:
    """Per stream (venue:symbol:type) its status, by the newest summary or health that names it, and the newest summary's run and metrics.

    A stream that only health events name has the run of the first of them; a
    name of other than three parts then is none.
    """
    said = found.withColumns({"said": F.try_parse_json("body"), "at": _at()})
    metric = said.where(F.col("kind") == SUMMARY).select("run_id", "recorded_at", "at", F.explode(_get("said", "stream_metrics", "array<variant>")).alias("one"))
    metric = metric.where(F.schema_of_variant("one").startswith("OBJECT"))
    degraded = F.lit(False)
    for name in DEGRADING:
        degraded = degraded | (F.coalesce(_get("one", name, "double"), F.lit(0)) > 0)
    named = metric.select("run_id", "recorded_at", "at", degraded.alias("bad"), F.to_json("one").alias("metrics"), F.upper(F.coalesce(_get("one", "venue"), F.lit(DEFAULT_VENUE))).alias("venue"), F.coalesce(_get("one", "symbol"), F.lit(DEFAULT_SYMBOL)).alias("symbol"), F.coalesce(_get("one", "stream_type"), F.lit(UNKNOWN)).alias("stream_type"))
    named = named.withColumn("scope", F.concat_ws(":", "venue", "symbol", "stream_type"))
    sick = said.where(F.col("kind") == HEALTH).select("run_id", "recorded_at", "at", F.explode(_get("said", "streams_degraded", "array<string>")).alias("scope"))
    parts = F.split("scope", ":")
    sick = sick.select("run_id", "recorded_at", "at", F.lit(True).alias("bad"), F.lit(None).cast("string").alias("metrics"), *[F.get(parts, k).alias(c) for k, c in enumerate(("venue", "symbol", "stream_type"))], "scope")
    rows = named.unionByName(sick)
    told = F.when(F.col("metrics").isNotNull(), F.col("at"))
    whole = rows.groupBy("scope").agg(
        *[F.coalesce(F.max_by(c, told), F.max(c)).alias(c) for c in ("venue", "symbol", "stream_type")],
        F.when(F.max_by("bad", "at"), "degraded").otherwise("ok").alias("status"),
        F.coalesce(F.max_by("run_id", told), F.min_by("run_id", "at")).alias("run_id"),
        F.max_by("recorded_at", "at").alias("updated_at"),
        F.max_by("metrics", told).alias("metrics"),
    )
    kept = whole.where(F.col("metrics").isNotNull() | (F.size(F.split("scope", ":")) == 3))
    return kept.withColumn("metrics", F.coalesce("metrics", F.lit('{"degraded_by_health":true}')))


def alerts(found: DataFrame) -> DataFrame:
    """Each alert once, by the digest of what it says, whatever the order of its keys."""
    rows = found.where(F.col("kind") == ALERT).withColumn("said", F.try_parse_json("body")).select("recorded_at", "run_id", "said", F.sha1(F.to_json("said")).alias("alert_id"))
    one = F.struct(
        _get("said", "trace_id").alias("trace_id"),
        F.coalesce(_get("said", "alert_type"), F.lit(UNKNOWN)).alias("alert_type"),
        F.coalesce(_get("said", "alert_severity"), _get("said", "severity"), F.lit("warning")).alias("severity"),
        F.coalesce(_get("said", "observed", "double"), F.lit(0.0)).alias("observed"),
        F.coalesce(_get("said", "threshold", "bigint"), F.lit(0)).alias("threshold"),
        F.coalesce(_get("said", "recommended_action"), F.lit("")).alias("recommended_action"),
        F.col("recorded_at").alias("created_at"),
    )
    return rows.groupBy("alert_id").agg(F.min(one).alias("one")).select("alert_id", "one.*")


def checkpoints(found: DataFrame) -> DataFrame:
    """The newest checkpoint of each stream; those of no stream or of all are left out."""
    rows = found.where(F.col("kind") == CHECKPOINT).withColumns({"said": F.try_parse_json("body"), "at": _at()}).withColumn("stream_key", _get("said", "stream_key"))
    one = F.struct(
        F.coalesce(_get("said", "checkpoint_path"), F.lit("")).alias("checkpoint_path"),
        F.col("recorded_at"),
        *[_get("said", c).alias(c) for c in ("checkpoint_last_event_ts", "cursor_kind", "cursor_value", "cursor_last_event_ts")],
        F.coalesce(_get("said", "cursor_seen_entry_count", "bigint"), F.lit(0)).alias("cursor_seen_entry_count"),
    )
    named = F.coalesce("stream_key", F.lit("")).isin("", "*")
    return rows.where(~named).select("stream_key", "at", one.alias("one")).groupBy("stream_key").agg(F.max_by("one", "at").alias("one")).select("stream_key", "one.*")


def with_status(found: DataFrame, status: str = "", symbol: str = "", stream_type: str = "", text: str = "") -> DataFrame:
    """Streams that meet all that is asked, in any case of letters, with ``text`` in their name; degraded ones first, then the newest."""
    out = found
    for column, value in (("status", status), ("symbol", symbol), ("stream_type", stream_type)):
        if value.strip():
            out = out.where(F.lower(column) == value.strip().lower())
    if text.strip():
        out = out.where(F.contains(F.lower("scope"), F.lit(text.strip().lower())))
    return out.orderBy(F.col("status") != "degraded", F.desc("updated_at"), "scope")
