"""What the operators share: tables in the shared scratch folder, and file access by URI."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Spaces of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of a portion that Python code turns into objects at once; Spark bounds what a batch has
#: (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB unless set).
PORTION_BYTES = 2 << 20
_own: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where that is unset, as in local tests, a temporary folder of this machine is taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return str(root).rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if app not in _own:
        _own[app] = f"file://{tempfile.mkdtemp(prefix='cantor-')}"
    return _own[app]


class Scratch:
    """Tables that cut lineage: written once, read by all, and removed when no longer needed."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/cantor/{label}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._quiet_drop)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _quiet_drop(self) -> None:
        try:
            self.drop("")
        except Exception:  # the session is gone; its folder goes with the cluster's clean-up
            pass


def portions(batches: Iterator[pa.RecordBatch], most: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into portions of about ``most`` bytes: long texts come one by one, short ones together."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have; Spark's names differ by more than case."""
    taken = {c.lower() for c in df.columns}
    return next(x for i in range(len(taken) + 1) if (x := f"_{name}{i or ''}").lower() not in taken)


def open_uri(uri: str):
    """A file system and a path in it, for a path as Spark prints it (``file:/x`` or ``scheme://host/x``)."""
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return pafs.FileSystem.from_uri(uri)
