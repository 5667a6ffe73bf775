"""Feature vectors at rest: upserts, runs, latest and history tables."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalbook.operators.asof import latest, retained

VECTOR_KEY = ("entity_scope", "event_us", "feature_set_name", "feature_set_version", "lineage_id")


def upserted(existing: DataFrame | None, new: DataFrame, key: Sequence[str] = VECTOR_KEY, order: str = "arrival_seq") -> DataFrame:
    """Existing and new vectors; of those with equal key the last to arrive stays."""
    both = new if existing is None else existing.unionByName(new, allowMissingColumns=True)
    return latest(both, list(key), [order])


class FeatureStore:
    """A store in a folder: versions of the vector table, swapped by writing a new one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @property
    def version(self) -> int:
        """The last version in the folder that was written to its end; 0 if there is none."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return max((int(f.getPath().getParent().getName()[1:]) for f in found or ()), default=0)

    def _at(self, version: int) -> str:
        return f"{self.path}/v{version}"

    def vectors(self) -> DataFrame | None:
        at = self.version
        return self.spark.read.parquet(self._at(at)) if at else None

    def put(self, new: DataFrame) -> None:
        """Upsert vectors by their key."""
        at = self.version
        upserted(self.vectors(), new).write.mode("overwrite").parquet(self._at(at + 1))

    def prune(self, now_us: int, ttl_us: int, keep: int) -> None:
        """Apply retention to the history of each scope and set."""
        rows = self.vectors()
        if rows is not None:
            retained(rows, ["entity_scope", "feature_set_name", "feature_set_version"], now_us, ttl_us, keep).write.mode("overwrite").parquet(self._at(self.version + 1))

    def latest(self) -> DataFrame | None:
        """The last upserted vector of each scope and set."""
        rows = self.vectors()
        return None if rows is None else latest(rows, ["entity_scope", "feature_set_name", "feature_set_version"])


def bundle_id(definition_hash: str, fingerprint: str, run_id: str) -> str:
    return hashlib.sha256(f"{definition_hash}|{fingerprint}|{run_id}".encode()).hexdigest()[:32]


def fingerprint(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: a digest of all rows that no order changes, and their number."""
    wide = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    return events.agg(F.count("*").alias("rows"), F.sha2(F.concat_ws("|", F.count("*").cast("string"), wide.cast("string")), 256).alias("fingerprint"))


def journal(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """An event journal: equal events once, whatever how often they were appended."""
    both = new if existing is None else existing.unionByName(new)
    return both.dropDuplicates()
