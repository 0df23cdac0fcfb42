"""Session factory for scripts and tests; a cluster's own session works just as well."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a skewed join be split even when the operator above it then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "refrain", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
