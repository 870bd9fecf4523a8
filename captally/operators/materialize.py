"""Lineage control for multi-step jobs.

``cut`` writes a finished table to the session's checkpoint folder -- the
shared folder named by ``spark.checkpoint.dir`` on a cluster -- and reads it
back, so later steps start from it instead of re-running the job, and no
executor's loss can take it away.  ``scratch_path`` names a folder there for
files that a job writes and reads itself.  Everything written this way is
removed when the driver's Python ends.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from captally.session import ensure_checkpoint_dir

_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/captally-{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(remove_scratch)
    _WRITTEN.append(path)
    return path


def remove_scratch() -> int:
    """Delete what this process wrote under the checkpoint folder; returns how many folders went."""
    sc = SparkContext._active_spark_context
    gone = 0
    while _WRITTEN and sc is not None:
        path = sc._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        gone += bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))
    return gone


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and read it back.

    Unlike ``Dataset.checkpoint`` this keeps a columnar file with statistics,
    so later joins know its size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
