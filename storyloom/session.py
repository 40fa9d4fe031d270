"""Session builder with the settings the engine is designed around."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "storyloom", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow on; partition counts are left to the cluster unless given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**settings, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()
