"""Session defaults and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

# Independent tables are submitted from this many threads, so that small ones do not wait for large.
MAX_CONCURRENT = 8

# Runtime settings every job of this package profits from. Sizes (shuffle partitions, memory,
# split size) belong to the cluster and are left alone.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a local master gets one for the session.

    Elsewhere a folder of the driver would not be seen by the executors, so the setting must be there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not configured and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="millrace-checkpoint-"))
    return configured or context.getCheckpointDir()


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that no other run uses; :func:`discard_scratch` removes it."""
    path = f"{shared_root(spark).rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def discard_scratch(spark: SparkSession) -> int:
    """Delete what this process has put into the shared folder, once no frame reads it any more."""
    found = 0
    while _scratch:
        fs, handle = hadoop_path(spark, _scratch.pop())
        found += bool(fs.delete(handle, True))
    return found


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame reliably, so that lost executors do not bring back its whole history."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def keep_columns(df: DataFrame, label: str) -> DataFrame:
    """Materialise a frame as a table of columns in the shared folder; later reads open only those they need."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop file system and path, for existence checks and pointer files on any storage."""
    jvm = spark.sparkContext._jvm
    handle = jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), handle


def for_each(function: Callable[[Item], Result], items: Iterable[Item]) -> list[Result]:
    """Submit independent Spark jobs side by side; results keep the order, the first error is raised."""
    work = list(items)
    if not work:
        return []
    with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT, len(work))) as pool:
        return list(pool.map(function, work))
