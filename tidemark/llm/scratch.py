"""Shared scratch space for tables that cut lineage.

The folder comes from ``spark.checkpoint.dir``, which every executor and the
driver can reach. A session on a local master without that setting (tests, a
laptop) gets a folder below the system's temporary directory; on a cluster there
is no such folder, and the lack of the setting is an error.

Operators drop the tables that nothing reads any more. Those that a returned
DataFrame still reads go when the driver ends.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"{_KEY} must name a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "tidemark-scratch")
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


_left: set[str] = set()


def _sweep(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is None:  # the session ended before
        return
    for path in list(_left):
        try:
            remove(spark, path)
        except Exception:  # the driver is ending; what stays is only scratch
            return


def lasting(spark: SparkSession, label: str) -> str:
    """A new path whose content goes when the driver ends."""
    path = new_path(spark, label)
    if not _left:
        atexit.register(_sweep, spark)
    _left.add(path)
    return path


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends here."""
    spark = df.sparkSession
    path = lasting(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.tidemark_path = path  # for drop()
    return out


def drop(df: DataFrame | None) -> None:
    """Delete a table made by :func:`cut` that nothing reads any more."""
    path = getattr(df, "tidemark_path", None)
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    _left.discard(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of each action go when the action ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)
