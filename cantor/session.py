"""Session defaults shared by the entry module, the tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session with the engine's defaults; on a cluster the submitter's own settings win."""
    builder = SparkSession.builder.master(master).appName("cantor")
    for key, value in (DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
