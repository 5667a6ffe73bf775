"""A session with the settings that this library expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(name: str = "tidalbook", **more: str) -> SparkSession:
    """Get or create a session. ``more`` takes settings with ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names, which all executors share.

    A local session without that setting gets a temporary folder; on a cluster
    the setting must be there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().replace("file:/", "file:///", 1).replace("file:////", "file:///")
