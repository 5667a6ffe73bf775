"""Dataset quality, catalogs, service levels, contracts and lifecycle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalbook.operators.scan import AUTO, Width, fresh, last_before, positions, spread

HOT_DAYS, WARM_DAYS = 7, 30


def quality_report(rows: DataFrame, dataset: Sequence[str], natural_key: Sequence[str], provider_ts: str, lineage: str, time_us: str, order: Sequence[str], width: Width = AUTO) -> DataFrame:
    """Per dataset: counts of defects, a score from 0 to 100 and a status.

    duplicates: rows beyond the first of a natural key. out_of_order: rows
    earlier than the last known time before them. A null dataset is a dataset. score = 100 - 5 duplicates -
    missing provider times - 3 missing lineages - 10 out of order, at least 0.
    """
    (before,) = fresh(rows.columns, "time_before")
    marked = last_before(rows, dataset, order, F.col(time_us), before, spread(rows, dataset, order, width))
    per_row = marked.groupBy(*dataset).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(provider_ts).isNull()).alias("missing_provider"),
        F.count_if(F.col(lineage).isNull()).alias("missing_lineage"),
        F.count_if(F.col(time_us) < F.col(before)).alias("out_of_order"),
    )
    n, *of = fresh([*dataset, *natural_key], "copies", *[f"of_{c}" for c in dataset])
    copies = rows.groupBy(*dataset, *natural_key).agg(F.count("*").alias(n)).groupBy(*[F.col(c).alias(o) for c, o in zip(dataset, of, strict=True)]).agg(F.sum(F.col(n) - 1).alias("duplicates"))
    out = per_row.join(copies, [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(dataset, of, strict=True)]).drop(*of)
    score = F.greatest(F.lit(0), 100 - 5 * F.col("duplicates") - F.col("missing_provider") - 3 * F.col("missing_lineage") - 10 * F.col("out_of_order"))
    errors = F.col("duplicates") + F.col("out_of_order") + F.col("missing_lineage")
    issues = errors + F.col("missing_provider")
    out = out.withColumn("score", score.cast("bigint"))
    return out.withColumn("status", F.when(issues == 0, "healthy").when((F.col("score") < 75) & (errors > 0), "failed").otherwise("degraded"))


def catalog(contracts: DataFrame, quality: DataFrame, promoted: DataFrame) -> DataFrame:
    """Contracts with their quality (by path) and the sorted targets they are promoted to."""
    targets = promoted.groupBy("path").agg(F.array_join(F.array_sort(F.collect_set("target")), ",").alias("targets"))
    return contracts.join(quality, "path", "left").join(targets, "path", "left")


def service_levels(entries: DataFrame, delivery: DataFrame) -> DataFrame:
    """Catalog entries with a service status by quality and delivery contract."""
    joined = entries.join(delivery, ["venue", "stream"], "left")
    status = F.when(F.col("quality_status") == "failed", "breached").when(F.col("delivery").isNull(), "uncontracted").when(F.col("quality_status") == "degraded", "at_risk").when(F.col("quality_status").isNull(), "unknown").otherwise("met")
    return joined.withColumn("service_status", status)


def tier(days_old: Column) -> Column:
    """hot up to a week, warm up to thirty days, then cold."""
    return F.when(days_old <= HOT_DAYS, "hot").when(days_old <= WARM_DAYS, "warm").otherwise("cold")


def downsample(rows: DataFrame, keys: Sequence[str], order: Sequence[str], every: int, width: Width = AUTO) -> DataFrame:
    """Rows number 1, 1 + every, 1 + 2 every and so on of each key."""
    (at,) = fresh(rows.columns, "place")
    return positions(rows, keys, order, at, spread(rows, keys, order, width)).where((F.col(at) - 1) % every == 0).drop(at)


def nearest_rank(values: DataFrame, keys: Sequence[str], value: str, q: float) -> DataFrame:
    """Per key the value at index round((n - 1) * q), ties to even, of the sorted values.

    Equal values are counted first; what is then ranked is one row per value.
    """
    counted = values.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(value))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    ranked = counted.withColumns({"_upto": upto, "_at": F.bround((total - 1) * F.lit(q)).cast("bigint") + 1})
    return ranked.where(F.col("_upto") >= F.col("_at")).groupBy(*keys).agg(F.min(value).alias("percentile"))


def contract_reasons(columns: Sequence[str], required: Sequence[str], allowed: Sequence[str] | None = None) -> list[str]:
    """Why a table's columns break a contract: missing ones, and others if ``allowed`` is given."""
    out = [f"missing:{c}" for c in required if c not in columns]
    return out + [f"unexpected:{c}" for c in columns if allowed is not None and c not in allowed]
