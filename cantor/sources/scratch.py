"""A folder for what a query writes to read it again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir, which all machines share; only a local session without it takes its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = _own.setdefault(spark.sparkContext.applicationId, "")
        if not root:
            root = _own[spark.sparkContext.applicationId] = f"file://{tempfile.mkdtemp(prefix='cantor-')}"
    return f"{root.rstrip('/')}/cantor-{label}-{uuid.uuid4().hex[:12]}"
