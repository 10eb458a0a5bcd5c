"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods above 8000 bytes of code.  A long word list makes
    # one of a fused stage; unfused, its pieces are compiled (ten times faster, measured).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Adaptive execution merges small partitions and never adds any: a cluster begins with many.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096"}


def build_session(app: str = "quarterdeck", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SQL_SETTINGS``, off one machine with ``CLUSTER_SETTINGS`` too; ``extra`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SQL_SETTINGS if (master or "").startswith("local") else SQL_SETTINGS | CLUSTER_SETTINGS
    for key, value in settings.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
